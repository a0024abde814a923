"""Controls kept as rows: every expression is a text, checked against its source before anything runs.

A row is (control, source, date, zero_fill, rules, cells, keys), see ``CONTROLS``. Either ``cells`` lists the expected cells,
or ``keys`` says how they are taken from the source's history. In a rule, ``metric`` and ``metric_detail`` are literals and
``metric_of`` and ``metric_detail_of`` are expressions; one of each pair is given. A condition may name the day of the run as ``:as_of``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygrid.sinks.tables import replace_table
from tallygrid.sources.tables import Tables, lookup
from tallygrid.spec import ControlSpec, KeysOf, Rule, checked

CONTROLS = (
    "control string, source string, date string, zero_fill boolean, "
    "rules array<struct<metric: string, metric_of: string, metric_detail: string, metric_detail_of: string, condition: string, measure: string>>, "
    "cells array<struct<metric: string, metric_detail: string>>, "
    "keys struct<metric_detail: string, metrics: array<struct<metric: string, value: string>>>"
)
AS_OF = ":as_of"
#: The day that conditions are checked with.
_ANY_DAY = dt.date(2000, 1, 1)


@dataclass(frozen=True)
class Fault:
    control: str
    field: str
    reason: str

    def __str__(self) -> str:
        return f"{self.control}: {self.field}: {self.reason}"


class InvalidControls(ValueError):
    """What is wrong with stored controls, all of it; nothing has been run."""

    def __init__(self, faults: Sequence[Fault]) -> None:
        super().__init__("\n".join(map(str, faults)))
        self.faults = tuple(faults)


def load_controls(spark: SparkSession, stored: DataFrame, tables: Tables | None = None) -> list[ControlSpec]:
    """The controls of ``stored`` in the order of their ids; raises ``InvalidControls`` with every fault of every control.

    Checked are the sources, that each expression can be read and resolved against its source, that dates are dates or timestamps,
    conditions are true or false, measures are numbers and keys can be shown as text, and what ``ControlSpec`` asks for.
    Only schemas are looked at; no row of a source is read. There are as many rows as controls.
    """
    table = lookup(spark, tables)
    specs, faults = [], []
    for row in sorted(stored.collect(), key=lambda r: r.control or ""):
        found = _Checked(row, table)
        faults += found.faults
        if not found.faults:
            try:
                specs.append(found.spec())
            except ValueError as fault:
                faults.append(Fault(found.name, "control", str(fault)))
    names = [spec.control for spec in specs]
    faults += [Fault(name, "control", "is defined twice") for name in sorted({n for n in names if names.count(n) > 1})]
    if faults:
        raise InvalidControls(faults)
    return checked(specs)


class _Checked:
    """One stored control with its texts turned into columns."""

    def __init__(self, row: Row, table: Callable[[str], DataFrame]) -> None:
        self.row, self.name, self.faults = row, row.control or "(no id)", []
        if not row.control:
            self._fault("control", "has no id")
        self.frame: DataFrame | None = None
        try:
            self.frame = table(row.source)
        except (AnalysisException, KeyError, TypeError) as fault:
            self._fault("source", _first_line(fault))
            return
        date = self._column("date", row.date, "a date or timestamp", lambda t: isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)))
        if date is not None and not any(row.date.lower() == c.lower() for c in self.frame.columns):
            self._fault("date", f"{row.date!r} is not a column of the source")
        if not row.rules:
            self._fault("rules", "there is none")
        self.rules = [self._rule(i, r) for i, r in enumerate(row.rules or ())]
        if bool(row.cells) == (row.keys is not None):
            self._fault("cells", "either cells or keys have to be given")
        self.keys = None if row.keys is None else self._keys(row.keys)

    def _fault(self, field: str, reason: str) -> None:
        self.faults.append(Fault(self.name, field, reason))

    def _column(self, field: str, text: str | None, wanted: str, fits: Callable[[T.DataType], bool]) -> Column | None:
        """The text as a column, if the source has what it names and it is of a kind that fits."""
        if not text:
            self._fault(field, "is missing")
            return None
        try:
            column = F.expr(text)
            kind = self.frame.select(column.alias("checked")).schema["checked"].dataType
        except (AnalysisException, ParseException) as fault:
            self._fault(field, _first_line(fault))
            return None
        if not fits(kind):
            self._fault(field, f"{text!r} is {kind.simpleString()}, not {wanted}")
        return column

    def _rule(self, i: int, rule: Row) -> Rule | None:
        label = f"rules[{i}]"
        sides = []
        for literal, expression, field in ((rule.metric, rule.metric_of, "metric"), (rule.metric_detail, rule.metric_detail_of, "metric_detail")):
            if (literal is None) == (expression is None):
                self._fault(f"{label}.{field}", "has to be given as a literal or as an expression")
                sides.append(None)
            else:
                sides.append(literal if literal is not None else self._column(f"{label}.{field}_of", expression, "a simple value", _shown))
        condition = measure = None
        if rule.condition is not None:
            on = lambda day: rule.condition.replace(AS_OF, f"DATE'{day}'")
            condition = self._column(f"{label}.condition", on(_ANY_DAY), "true or false", lambda t: isinstance(t, T.BooleanType))
            if AS_OF in rule.condition:
                condition = lambda day: F.expr(on(day))
        if rule.measure is not None:
            measure = self._column(f"{label}.measure", rule.measure, "a number", lambda t: isinstance(t, T.NumericType))
        return None if any(side is None for side in sides) else Rule(*sides, when=condition, measure=measure)

    def _keys(self, keys: Row) -> KeysOf | None:
        detail = self._column("keys.metric_detail", keys.metric_detail, "a simple value", _shown)
        metrics = {}
        for i, metric in enumerate(keys.metrics or ()):
            if not metric.metric:
                self._fault(f"keys.metrics[{i}]", "has no name")
            metrics[metric.metric] = None if metric.value is None else self._column(f"keys.metrics[{i}].value", metric.value, "a value", lambda t: True)
        if not metrics:
            self._fault("keys.metrics", "there is none")
        return None if detail is None else KeysOf(detail, metrics)

    def spec(self) -> ControlSpec:
        row = self.row
        grid = self.keys if self.keys is not None else [(c.metric, c.metric_detail) for c in row.cells]
        return ControlSpec(row.control, row.source, row.date, self.rules, grid, row.zero_fill is not False)


def _shown(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))


def _first_line(fault: Exception) -> str:
    return (str(fault).strip() or type(fault).__name__).splitlines()[0]


def control_rows(
    spark: SparkSession, specs: Sequence[ControlSpec], tables: Tables | None = None, conditions: Mapping[tuple[str, int], str] | None = None
) -> DataFrame:
    """``specs`` as rows of ``CONTROLS``; their columns are written as they are resolved against the sources.

    A condition that depends on the day of the run is a function and has no text of its own; ``conditions`` gives it, by control
    and number of the rule.
    """
    table = lookup(spark, tables)
    rows = []
    for spec in checked(specs):
        empty = spark.createDataFrame([], table(spec.source).schema)
        rules = []
        for i, rule in enumerate(spec.rules):
            if rule.when is None or isinstance(rule.when, Column):
                when = _sql(empty, rule.when)
            elif (spec.control, i) in (conditions or {}):
                when = conditions[spec.control, i]
            else:
                raise ValueError(f"{spec.control}: rule {i} has a condition of the day, whose text has to be given")
            sides = [side for key in (rule.metric, rule.metric_detail) for side in ((key, None) if isinstance(key, str) else (None, _sql(empty, key)))]
            rules.append((*sides, when, _sql(empty, rule.measure)))
        keys = None
        if not spec.static:
            keys = (_sql(empty, spec.grid.metric_detail), [(label, _sql(empty, c)) for label, c in spec.grid.metrics.items()])
        rows.append((spec.control, spec.source, spec.date, spec.zero_fill, rules, list(spec.grid) if spec.static else None, keys))
    return spark.createDataFrame(rows, CONTROLS)


def store_controls(spark: SparkSession, rows: DataFrame, target: str, tables: Tables | None = None) -> list[ControlSpec]:
    """Replaces the stored controls by ``rows`` if all of them are sound; the list that they give."""
    specs = load_controls(spark, rows, tables)
    replace_table(rows, target)
    return specs


def _sql(empty: DataFrame, column: Column | None) -> str | None:
    """A column's SQL text, resolved against a frame of the source's columns."""
    if column is None:
        return None
    named = empty.select(column.alias("text"))._jdf.queryExecution().analyzed().expressions().apply(0)
    return named.child().sql()
