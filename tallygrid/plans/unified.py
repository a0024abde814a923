"""The unified table: counts, change and freshness of all controls in one long relation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.functions.dates import DateSpan
from tallygrid.operators.change import period_change
from tallygrid.operators.counts import grid_counts
from tallygrid.operators.derived import counts_with_keys, keys_and_incidents
from tallygrid.operators.freshness import attach_refresh, refresh_times
from tallygrid.operators.grid import date_spine
from tallygrid.operators.grid import scaffold as build_scaffold
from tallygrid.operators.incidents import incidents
from tallygrid.sources.tables import Tables, lookup
from tallygrid.spec import CELL, ControlSpec, RefreshSource, checked

UNIFIED = (*CELL, "control_count", "daily_absolute_change", "daily_percent_change", "last_refresh_time")


def control_counts(
    spark: SparkSession,
    specs: Sequence[ControlSpec],
    as_of: dt.date,
    days: int = 5,
    tables: Tables | None = None,
    scaffold: DataFrame | None = None,
    span: DateSpan | None = None,
) -> DataFrame:
    """Counts of all controls per expected cell.

    All controls go through one aggregation. Pass a stored ``scaffold`` with its ``span`` to count on
    it; otherwise the scaffold is built for the ``days`` before ``as_of``.
    """
    span = span or DateSpan.before(as_of, days)
    tables = lookup(spark, tables)
    specs = checked(specs)
    sparse = {spec.control for spec in specs if not spec.zero_fill}
    if scaffold is not None:
        scaffold = scaffold.where(F.col("control").isin(*[spec.control for spec in specs]))
        return grid_counts(scaffold, incidents(spark, specs, span, as_of, tables), sparse)
    # A control whose keys come from its own source gets keys and counts from one pass over it.
    together = [spec for spec in specs if counts_with_keys(tables(spec.source), spec)]
    apart = [spec for spec in specs if spec not in together]
    grids, found = [], []
    if apart:
        grids.append(build_scaffold(spark, apart, span, tables))
        found.append(incidents(spark, apart, span, as_of, tables))
    for spec in together:
        keys, rows = keys_and_incidents(tables(spec.source), spec, span, as_of)
        grids.append(date_spine(keys, F.lit(span.first), F.lit(span.last)).select(*CELL))
        found.append(rows)
    return grid_counts(reduce(DataFrame.unionByName, grids), reduce(DataFrame.unionByName, found), sparse)


def unified(
    spark: SparkSession,
    specs: Sequence[ControlSpec],
    as_of: dt.date,
    days: int = 5,
    tables: Tables | None = None,
    mapping: Sequence[RefreshSource] = (),
    metadata: DataFrame | None = None,
) -> DataFrame:
    """Counts with day-over-day change and last refresh time, straight from the sources.

    Without ``metadata`` the refresh time is NULL throughout.
    """
    changes = period_change(control_counts(spark, specs, as_of, days, tables))
    return with_refresh(spark, changes, mapping, metadata)


def with_refresh(
    spark: SparkSession, changes: DataFrame, mapping: Sequence[RefreshSource], metadata: DataFrame | None
) -> DataFrame:
    if metadata is None:
        return changes.selectExpr("*", "CAST(NULL AS TIMESTAMP) AS last_refresh_time").select(*UNIFIED)
    refresh = refresh_times(spark, mapping, metadata)
    return attach_refresh(changes, refresh, len({m.control for m in mapping})).select(*UNIFIED)
