"""The dense grid of expected cells: every metric of every control on every day of the span."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.functions.dates import DateSpan
from tallygrid.operators.keys import grid_of_keys
from tallygrid.sources.local import literal_rows
from tallygrid.sources.tables import Tables, lookup
from tallygrid.spec import CELL, SERIES, ControlSpec, KeysOf, checked


def date_spine(rows: DataFrame, first: Column, last: Column, name: str = "control_date") -> DataFrame:
    """Each row repeated once per day from ``first`` to ``last``, both included.

    Expands in place, so pairing rows with days needs neither a join nor a shuffle.
    """
    return rows.withColumn(name, F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))))


def source_keys(source: DataFrame, control: str, keys: KeysOf) -> DataFrame:
    """Expected cells of a data-derived grid.

    The source is read once and reduced to one row per detail with a presence flag per metric.
    Whether a metric is present anywhere comes from a second, global reduction of those rows, used as
    a scalar subquery. Both sides keep the flags, so they share one shuffle of the source.
    """
    gated = {label: column.isNotNull() for label, column in keys.metrics.items() if column is not None}
    flags = {label: f"has_{i}" for i, label in enumerate(gated)}
    details = source.select(
        keys.metric_detail.cast("string").alias("metric_detail"), *[gated[m].alias(flag) for m, flag in flags.items()]
    )
    return keys_of_details(details, control, keys.metrics, flags)


def keys_of_details(details: DataFrame, control: str, metrics: Mapping[str, Column | None], flags: Mapping[str, str]) -> DataFrame:
    """Expected cells from rows of (metric_detail, flag columns); ``flags`` names the column of each gated metric."""
    if flags:
        details = details.groupBy("metric_detail").agg(*[F.bool_or(flag).alias(flag) for flag in flags.values()])
        anywhere = details.agg(F.struct(*[F.bool_or(flag).alias(flag) for flag in flags.values()])).scalar()
        details = details.withColumn("anywhere", anywhere)
    else:
        details = details.select("metric_detail").distinct()
    labels = [
        F.when(F.col(flags[label]) | F.col("anywhere")[flags[label]], F.lit(label)) if label in flags else F.lit(label)
        for label in metrics
    ]
    return details.select(
        F.lit(control).alias("control"), F.explode(F.array(*labels)).alias("metric"), "metric_detail"
    ).where(F.col("metric").isNotNull())


def metric_grid(
    spark: SparkSession, specs: Sequence[ControlSpec], tables: Tables | None = None, keys: DataFrame | None = None
) -> DataFrame:
    """(control, metric, metric_detail) of all specs, without dates. Rows are unique.

    Derived grids come from stored ``keys`` (see ``operators.keys``) where given, else from the history of their sources.
    """
    specs = checked(specs)
    table = lookup(spark, tables)
    parts = [
        source_keys(table(spec.source), spec.control, spec.grid) if keys is None else grid_of_keys(keys, spec)
        for spec in specs
        if not spec.static
    ]
    static = [(spec.control, metric, detail) for spec in specs if spec.static for metric, detail in spec.grid]
    if static:
        parts.insert(0, literal_rows(spark, SERIES, static))
    return reduce(DataFrame.unionByName, parts)


def scaffold(
    spark: SparkSession,
    specs: Sequence[ControlSpec],
    span: DateSpan,
    tables: Tables | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """The metric grid on every day of the span."""
    grid = metric_grid(spark, specs, tables, keys)
    return date_spine(grid, F.lit(span.first), F.lit(span.last)).select(*CELL)
