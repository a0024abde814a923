"""Rows written in a spec, as a local relation."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def literal_rows(spark: SparkSession, columns: Sequence[str], rows: Sequence[Sequence[str | None]]) -> DataFrame:
    """String rows known at build time.

    Built from an Arrow table because that plans as a LocalTableScan; a list of tuples would plan as
    a scan over a Python RDD.
    """
    schema = pa.schema([(name, pa.string()) for name in columns])
    return spark.createDataFrame(
        pa.Table.from_pylist([dict(zip(columns, row, strict=True)) for row in rows], schema=schema)
    )
