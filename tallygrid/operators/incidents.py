"""Source rows to incidents: (control, control_date, metric, metric_detail, weight, hits)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygrid.functions.conditions import all_of, any_of
from tallygrid.functions.dates import DateSpan
from tallygrid.sources.tables import Tables, lookup
from tallygrid.spec import ControlSpec, Rule, checked

# A rule over a category column is spelled out as one counter per expected category, so that it can
# share a scan with the other rules of its source, up to this many categories.
SPELLED_OUT_CELLS = 16

# Digits of the sums of decimal measures. Their scale is at least this and never less than the measure's, so nothing is rounded.
DECIMAL_DIGITS = 38
LEAST_SCALE = 6


@dataclass(frozen=True, eq=False)
class _Counter:
    """A rule ready to be counted: literal or column keys, the full condition, and the weight."""

    control: str
    date: str
    metric: str | Column
    metric_detail: str | Column
    condition: Column | None
    measure: Column | None
    kind: str

    def fields(self, weight: Column, hits: Column) -> list[Column]:
        return [
            F.lit(self.control).alias("control"),
            F.col("control_date"),
            _text(self.metric).alias("metric"),
            _text(self.metric_detail).alias("metric_detail"),
            weight.alias("weight"),
            hits.alias("hits"),
        ]


def incidents(
    spark: SparkSession,
    specs: Sequence[ControlSpec],
    span: DateSpan,
    as_of: dt.date,
    tables: Tables | None = None,
) -> DataFrame:
    """Incidents of all specs inside the span; a row stands for ``hits`` incidents of total ``weight``.

    Every scan carries the date bounds and the rule conditions, and reads only the columns that its
    rules mention. Rules over the same source are counted side by side in one pass, see
    ``source_incidents``.
    """
    table = lookup(spark, tables)
    by_source = sorted(checked(specs), key=lambda spec: spec.source)
    parts = [
        part
        for source, group in groupby(by_source, key=lambda spec: spec.source)
        for part in source_incidents(table(source), list(group), span, as_of)
    ]
    return reduce(DataFrame.unionByName, parts)


def source_incidents(
    source: DataFrame, specs: Sequence[ControlSpec], span: DateSpan, as_of: dt.date
) -> Iterable[DataFrame]:
    """Incidents of the controls over one source.

    A single rule yields its rows as they are; counting them is left to the aggregation over all
    controls, whose map side collapses them before anything is shuffled.

    Several rules would give a row several incidents. Instead of multiplying rows, rules with the same
    key columns become conditional counters of one aggregation by day and key, and its few result rows
    are unfolded into one row per rule afterwards. Rules of a static grid have no key columns once
    their categories are spelled out, so all of them share one pass over the source.
    """
    rules = [(spec, rule) for spec in specs for rule in spec.rules]
    kinds = measure_kinds(source, [rule for _, rule in rules])
    same = _SameColumn(source)
    scans: dict[tuple, list[_Counter]] = {}
    for (spec, rule), kind in zip(rules, kinds, strict=True):
        for counter in _counters(spec, rule, kind, as_of, spell_out=len(rules) > 1):
            keys = (same.number(key) for key in (counter.metric, counter.metric_detail))
            scans.setdefault((counter.date, counter.kind, *keys), []).append(counter)
    for counters in scans.values():
        day = F.col(counters[0].date).cast("date")
        bounded = span.holds(day)
        if len(counters) == 1:
            yield _rows(source, counters[0], day, bounded)
        else:
            yield _totals(source, counters, day, bounded)


class _SameColumn:
    """Numbers the key columns of a source so that columns meaning the same get the same number."""

    def __init__(self, source: DataFrame) -> None:
        self.source = source
        self.seen: list[tuple[Column, DataFrame]] = []

    def number(self, key: str | Column) -> int | None:
        if isinstance(key, str):
            return None
        for i, (column, _) in enumerate(self.seen):
            if column is key:
                return i
        selected = self.source.select(_text(key).alias("key"))
        for i, (_, other) in enumerate(self.seen):
            if selected.sameSemantics(other):
                return i
        self.seen.append((key, selected))
        return len(self.seen) - 1


def _rows(source: DataFrame, counter: _Counter, day: Column, bounded: Column) -> DataFrame:
    kept = source.where(bounded if counter.condition is None else bounded & counter.condition)
    one = F.lit(1).cast("bigint")
    weight = one if counter.measure is None else counter.measure
    control, _, *fields = counter.fields(weight, one)
    return kept.select(control, day.alias("control_date"), *fields)


def _totals(source: DataFrame, counters: Sequence[_Counter], day: Column, bounded: Column) -> DataFrame:
    metric, metric_detail = counters[0].metric, counters[0].metric_detail
    keys = [_text(key).alias(f"key_{i}") for i, key in enumerate((metric, metric_detail)) if not isinstance(key, str)]
    conditions = [F.lit(True) if c.condition is None else c.condition for c in counters]
    totals, slots = [], []
    for i, (counter, condition) in enumerate(zip(counters, conditions, strict=True)):
        hits = weight = F.col(f"hits_{i}")
        totals.append(F.count_if(condition).alias(f"hits_{i}"))
        if counter.measure is not None:
            weight = F.col(f"weight_{i}")
            totals.append(F.sum(F.when(condition, counter.measure)).cast(counter.kind).alias(f"weight_{i}"))
        slots.append(F.struct(*_keyed(counter).fields(weight, hits)))
    return (
        # The conditions go into the scan as one OR, so that statistics and dictionaries of the files can
        # rule out what no rule wants.
        source.where(bounded & any_of(conditions))
        .groupBy(day.alias("control_date"), *keys)
        .agg(*totals)
        .select(F.inline(F.array(*slots)))
        .where(F.col("hits") > 0)
    )


def _keyed(counter: _Counter) -> _Counter:
    """The counter after grouping: its key columns are now the grouping columns."""
    metric, metric_detail = (
        key if isinstance(key, str) else F.col(f"key_{i}") for i, key in enumerate((counter.metric, counter.metric_detail))
    )
    return _Counter(counter.control, counter.date, metric, metric_detail, None, counter.measure, counter.kind)


def _counters(spec: ControlSpec, rule: Rule, kind: str, as_of: dt.date, spell_out: bool) -> Iterable[_Counter]:
    """The rule with membership of its keys in the expected keys added to its condition.

    A NULL key never matches an expected cell, so it is dropped here. For a static grid the list of
    expected keys goes into the scan, which keeps unknown categories out of the shuffle. Exact cell
    membership is settled by the grid itself when counting.
    """
    own = [condition] if (condition := rule.condition(as_of)) is not None else []
    measure = None if rule.measure is None else rule.measure.cast(kind)

    def counter(metric: str | Column, detail: str | Column, *membership: Column) -> _Counter:
        terms = [*own, *membership]
        return _Counter(spec.control, spec.date, metric, detail, all_of(terms) if terms else None, measure, kind)

    cells = spec.cells_of(rule) if spec.static else []
    if spell_out and 0 < len(cells) <= SPELLED_OUT_CELLS:
        for metric, detail in cells:
            pairs = ((rule.metric, metric), (rule.metric_detail, detail))
            yield counter(metric, detail, *[_text(key) == value for key, value in pairs if not isinstance(key, str)])
        return
    membership = []
    for position, key in enumerate((rule.metric, rule.metric_detail)):
        if not isinstance(key, str):
            expected = dict.fromkeys(cell[position] for cell in cells)
            membership.append(_text(key).isin(*expected) if spec.static else _text(key).isNotNull())
    yield counter(rule.metric, rule.metric_detail, *membership)


def _text(value: str | Column) -> Column:
    return F.lit(value) if isinstance(value, str) else value.cast("string")


def measure_kinds(source: DataFrame, rules: Sequence[Rule]) -> list[str]:
    """Type of each rule's weight and of its sums: bigint for counts and integer measures, the widest decimal of
    the measure's scale for decimals, double for the rest.

    The type is kept through every sum, so it depends neither on how many cells a control has nor on
    the other controls of its source. The union of all controls takes the widest type of them; a sum that has more digits than
    that type is an error and never cut.
    """
    measured = [rule.measure for rule in rules if rule.measure is not None]
    if not measured:
        return ["bigint"] * len(rules)
    fields = iter(source.select(*[measure.alias(f"m{i}") for i, measure in enumerate(measured)]).schema.fields)
    types = [T.LongType() if rule.measure is None else next(fields).dataType for rule in rules]
    return [
        "bigint"
        if isinstance(kind, T.IntegralType)
        else f"decimal({DECIMAL_DIGITS},{max(LEAST_SCALE, kind.scale)})"
        if isinstance(kind, T.DecimalType)
        else "double"
        for kind in types
    ]
