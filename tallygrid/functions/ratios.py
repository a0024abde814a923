"""Division that yields NULL where there is no meaningful quotient."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient; NULL for a zero or NULL denominator, never an error and never infinity."""
    return F.try_divide(numerator, denominator)


def percent_change(current: Column, previous: Column) -> Column:
    """Change relative to ``previous`` in percent, as a double; NULL when ``previous`` is NULL or zero."""
    return safe_divide((current - previous).cast("double"), previous.cast("double")) * 100
