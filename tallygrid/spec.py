"""Declarative description of a control: what is expected, and what counts as an incident.

Adding a control means adding one ``ControlSpec`` to the list handed to the plans; no operator
changes. Specs hold ``Column`` expressions, so build them once a session exists.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column

SERIES = ("control", "metric", "metric_detail")
CELL = ("control", "control_date", "metric", "metric_detail")


@dataclass(frozen=True, eq=False)
class Rule:
    """One way for a source row to be an incident.

    ``metric`` and ``metric_detail`` name the cell the row falls into, as a literal string or as a
    column of the source. ``when`` is the condition (a function of the as-of date if it depends on
    the day of the run). Without ``measure`` every hit counts one; with it the hits are summed.
    A row that satisfies several rules is counted once for each of them.
    """

    metric: str | Column
    metric_detail: str | Column
    when: Column | Callable[[dt.date], Column] | None = None
    measure: Column | None = None

    def condition(self, as_of: dt.date) -> Column | None:
        return self.when(as_of) if callable(self.when) else self.when


@dataclass(frozen=True, eq=False)
class KeysOf:
    """Expected cells taken from the whole history of the control's own source.

    Every distinct ``metric_detail`` is paired with every metric. A metric mapped to a column is
    expected only if that column holds a value somewhere in the source; one mapped to None always.
    """

    metric_detail: Column
    metrics: Mapping[str, Column | None]


@dataclass(frozen=True, eq=False)
class ControlSpec:
    """A control: its source table, event date column, counting rules and expected cells.

    ``zero_fill=False`` keeps only the expected cells that had an incident, so that the change of
    such a control compares with the last day that had one.
    """

    control: str
    source: str
    date: str
    rules: Sequence[Rule]
    grid: Sequence[tuple[str, str]] | KeysOf
    zero_fill: bool = True

    def __post_init__(self) -> None:
        if not self.rules:
            raise ValueError(f"{self.control}: a control needs at least one rule")
        if self.static:
            object.__setattr__(self, "grid", tuple(tuple(cell) for cell in self.grid))
            if len(set(self.grid)) != len(self.grid):
                raise ValueError(f"{self.control}: the grid holds the same cell twice")
        for rule in self.rules:
            if not self._expects(rule):
                raise ValueError(f"{self.control}: no expected cell fits {rule.metric!r}, {rule.metric_detail!r}")

    @property
    def static(self) -> bool:
        return not isinstance(self.grid, KeysOf)

    def cells_of(self, rule: Rule) -> list[tuple[str, str]]:
        """Cells of a static grid that the rule can count into."""
        return [
            cell
            for cell in self.grid
            if all(
                not isinstance(key, str) or key == expected
                for key, expected in zip((rule.metric, rule.metric_detail), cell, strict=True)
            )
        ]

    def _expects(self, rule: Rule) -> bool:
        if self.static:
            return bool(self.cells_of(rule))
        return not isinstance(rule.metric, str) or rule.metric in self.grid.metrics


@dataclass(frozen=True)
class RefreshSource:
    """The table whose last modification stands for the freshness of a control."""

    control: str
    dataset_id: str
    table_id: str


def checked(specs: Sequence[ControlSpec]) -> list[ControlSpec]:
    """The specs as a list; raises when two share a control id (their cells would collide)."""
    specs = list(specs)
    if not specs:
        raise ValueError("no control given")
    seen: set[str] = set()
    for spec in specs:
        if spec.control in seen:
            raise ValueError(f"control {spec.control!r} is defined twice")
        seen.add(spec.control)
    return specs
