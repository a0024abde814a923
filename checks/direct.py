"""The yardstick: one join and one aggregation per control, on raw rows and without date bounds.

This is the obvious way to write the counts. Tests compare the library with it on random rows, and
``bench.py`` times it beside the library.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid import ControlSpec, DateSpan
from tallygrid import scaffold as build_scaffold
from tallygrid.spec import CELL

KEYS = ["control_date", "metric", "metric_detail"]


def direct_counts(
    spark: SparkSession, specs: Sequence[ControlSpec], as_of: dt.date, days: int, tables: Callable[[str], DataFrame]
) -> DataFrame:
    grid = build_scaffold(spark, specs, DateSpan.before(as_of, days), tables)
    return reduce(DataFrame.unionByName, [_counts(grid, spec, tables(spec.source), as_of) for spec in specs])


def _counts(grid: DataFrame, spec: ControlSpec, source: DataFrame, as_of: dt.date) -> DataFrame:
    def text(value):
        return F.lit(value) if isinstance(value, str) else value.cast("string")

    rows = []
    for rule in spec.rules:
        condition = rule.condition(as_of)
        rows.append(
            (source if condition is None else source.where(condition)).select(
                F.col(spec.date).cast("date").alias("control_date"),
                text(rule.metric).alias("metric"),
                text(rule.metric_detail).alias("metric_detail"),
                (F.lit(1) if rule.measure is None else rule.measure).alias("weight"),
                F.lit(1).alias("hit"),
            )
        )
    cells = grid.where(F.col("control") == spec.control)
    joined = cells.join(reduce(DataFrame.unionByName, rows), KEYS, "left" if spec.zero_fill else "inner")
    return joined.groupBy(*CELL).agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("control_count"))
