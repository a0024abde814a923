"""How the source name in a spec becomes a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cache

from pyspark.sql import DataFrame, SparkSession

Tables = Mapping[str, DataFrame] | Callable[[str], DataFrame]


def catalog_tables(spark: SparkSession, home: str | None = None) -> Callable[[str], DataFrame]:
    """Tables and views of the session catalog; bare names are looked up in the ``home`` schema."""

    def read(name: str) -> DataFrame:
        return spark.table(name if home is None or "." in name else f"{home}.{name}")

    return read


def parquet_tables(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    """Parquet datasets ``<folder>/<name>.parquet``."""
    return lambda name: spark.read.parquet(f"{folder}/{name}.parquet")


def lookup(spark: SparkSession, tables: Tables | None) -> Callable[[str], DataFrame]:
    """``tables`` as a function that resolves each name once."""
    if tables is None:
        tables = catalog_tables(spark)
    return cache(tables if callable(tables) else tables.__getitem__)
