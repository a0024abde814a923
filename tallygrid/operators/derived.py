"""Keys and counts of a control with a derived grid, from one pass over its source."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.functions.conditions import all_of
from tallygrid.functions.dates import DateSpan
from tallygrid.operators.grid import keys_of_details
from tallygrid.operators.incidents import measure_kinds
from tallygrid.spec import ControlSpec


def counts_with_keys(source: DataFrame, spec: ControlSpec) -> bool:
    """Whether every rule counts into a fixed metric under the very column that the grid's details come from."""
    if spec.static or not all(isinstance(rule.metric, str) and isinstance(rule.metric_detail, Column) for rule in spec.rules):
        return False
    keys = source.select(spec.grid.metric_detail.cast("string").alias("key"))
    return all(keys.sameSemantics(source.select(rule.metric_detail.cast("string").alias("key"))) for rule in spec.rules)


def keys_and_incidents(source: DataFrame, spec: ControlSpec, span: DateSpan, as_of: dt.date) -> tuple[DataFrame, DataFrame]:
    """(control, metric, metric_detail) of the whole history, and the incidents inside the span, of a control for which
    ``counts_with_keys`` holds.

    The source is reduced once, to a row for each detail and day of the span and one for each detail of the other days,
    with the presence flags of the keys beside the counters of the rules. Both results are read off these rows. They keep all columns
    of them, so that Spark shuffles them once and uses them again.
    """
    day = F.col(spec.date).cast("date")
    inside = span.holds(day)
    gated = {label: column for label, column in spec.grid.metrics.items() if column is not None}
    flags = {label: f"has_{i}" for i, label in enumerate(gated)}
    totals, slots = [F.bool_or(gated[label].isNotNull()).alias(flag) for label, flag in flags.items()], []
    for i, (rule, kind) in enumerate(zip(spec.rules, measure_kinds(source, spec.rules), strict=True)):
        own = rule.condition(as_of)
        condition = inside if own is None else all_of([inside, own])
        totals.append(F.count_if(condition).alias(f"hits_{i}"))
        hits = weight = F.col(f"hits_{i}")
        if rule.measure is not None:
            totals.append(F.sum(F.when(condition, rule.measure.cast(kind))).cast(kind).alias(f"weight_{i}"))
            weight = F.col(f"weight_{i}")
        slots.append(
            F.struct(
                F.lit(spec.control).alias("control"),
                F.col("control_date"),
                F.lit(rule.metric).alias("metric"),
                F.col("metric_detail"),
                weight.alias("weight"),
                hits.alias("hits"),
            )
        )
    reduced = source.groupBy(
        spec.grid.metric_detail.cast("string").alias("metric_detail"), F.when(inside, day).alias("control_date")
    ).agg(*totals)
    # True for every row, which the optimizer can't know: a use of all columns on both sides.
    reduced = reduced.where(F.pmod(F.xxhash64(*reduced.columns), F.lit(2)) >= 0)
    keys = keys_of_details(reduced.select("metric_detail", *flags.values()), spec.control, spec.grid.metrics, flags)
    # Days and details are tested behind the unfolding: a test before it would go down to the scan and make it another one than
    # that of the keys.
    return keys, reduced.select(F.inline(F.array(*slots))).where("hits > 0 AND control_date IS NOT NULL AND metric_detail IS NOT NULL")
