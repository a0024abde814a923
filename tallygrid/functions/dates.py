"""Calendar helpers: the as-of date, the span of days before it, and month tests."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class DateSpan:
    """Consecutive days, both ends included."""

    first: dt.date
    last: dt.date

    def __post_init__(self) -> None:
        if self.first > self.last:
            raise ValueError(f"empty span: {self.first} is after {self.last}")

    @classmethod
    def before(cls, as_of: dt.date, days: int = 5) -> DateSpan:
        """The ``days`` full days before ``as_of``, which is itself excluded."""
        if days < 1:
            raise ValueError("a span needs at least one day")
        return cls(as_of - dt.timedelta(days=days), as_of - dt.timedelta(days=1))

    def holds(self, day: Column) -> Column:
        """True for days inside the span.

        The bounds are literals, so on ``CAST(column AS DATE)`` Catalyst turns the test into a range
        on the raw column, and it reaches partition pruning and the parquet row-group statistics.
        """
        return day.between(F.lit(self.first), F.lit(self.last))


def resolve_as_of(spark: SparkSession, as_of: dt.date | None = None) -> dt.date:
    """``as_of`` if given, else today as Spark sees it, in whatever form the session time zone is set."""
    if as_of is not None:
        return as_of
    return spark.range(1).select(F.current_date()).first()[0]


def same_month(day: Column, as_of: dt.date) -> Column:
    """True when ``day`` is in the calendar month of ``as_of``.

    Written as a range with constant ends instead of comparing two truncated dates, so that it can
    be pushed into the scan.
    """
    start = F.trunc(F.lit(as_of), "MONTH")
    day = day.cast("date")
    return (day >= start) & (day < F.add_months(start, 1))
