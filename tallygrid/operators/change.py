"""Change against the previous row of a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygrid.functions.ratios import percent_change
from tallygrid.spec import SERIES


def period_change(
    counts: DataFrame,
    keys: Sequence[str] = SERIES,
    order: str = "control_date",
    value: str = "control_count",
    absolute: str = "daily_absolute_change",
    percent: str = "daily_percent_change",
) -> DataFrame:
    """Adds the absolute and the percent change of ``value`` against the previous row of its series.

    The first row of a series has no change, and growth from 0 has no percentage. The lagged value is
    named once, so both columns share one window and one sort of the already aggregated rows; a
    window partition never holds more rows than the span has days.
    """
    series = Window.partitionBy(*keys).orderBy(order)
    current, previous = F.col(value), F.col("previous_value")
    return (
        counts.withColumn("previous_value", F.lag(value).over(series))
        .withColumns({absolute: current - previous, percent: percent_change(current, previous)})
        .drop("previous_value")
    )
