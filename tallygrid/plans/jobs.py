"""The refreshes, each replacing one stored relation. When they run is up to the caller."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.functions.dates import DateSpan, resolve_as_of
from tallygrid.operators.change import period_change
from tallygrid.operators.freshness import attach_refresh, refresh_select
from tallygrid.operators.grid import scaffold
from tallygrid.operators.keys import KEYS, definition, extended_keys
from tallygrid.plans.unified import UNIFIED, control_counts
from tallygrid.sinks.tables import replace_table, replace_view
from tallygrid.sources.metadata import live_metadata_select, table_metadata
from tallygrid.sources.tables import Tables, lookup
from tallygrid.spec import ControlSpec, RefreshSource, checked


def refresh_scaffold(
    spark: SparkSession,
    specs: Sequence[ControlSpec],
    target: str,
    as_of: dt.date | None = None,
    days: int = 5,
    tables: Tables | None = None,
    keys: str | None = None,
) -> None:
    """Rebuilds the stored scaffold.

    Derived grids need the whole history of their sources, unless ``keys`` names a registry that ``refresh_keys`` keeps up to date.
    """
    span = DateSpan.before(resolve_as_of(spark, as_of), days)
    known = None if keys is None else spark.table(keys)
    replace_table(scaffold(spark, specs, span, tables, known), target)


def refresh_keys(
    spark: SparkSession,
    specs: Sequence[ControlSpec],
    target: str,
    as_of: dt.date | None = None,
    tables: Tables | None = None,
    late_days: int = 0,
    rebuild: Collection[str] = (),
) -> None:
    """Extends the stored key registry of all derived grids, or begins it.

    Of each source only the days after the last one that was merged are read, ``late_days`` before them (rows that
    arrive late), and rows without a date. A control that is new, whose definition has changed, or that is listed in
    ``rebuild``, is taken from the whole history again. Days before ``as_of`` count as merged afterwards. Keys never expire, as
    in the whole-history form, until a rebuild finds their rows gone. Controls that aren't given leave the registry.
    """
    as_of = resolve_as_of(spark, as_of)
    merged = as_of - dt.timedelta(days=1)
    table = lookup(spark, tables)
    derived = [spec for spec in checked(specs) if not spec.static]
    known, merged_until = None, {}
    if spark.catalog.tableExists(target):
        known = spark.table(target)
        # One row for each control.
        for row in known.groupBy("control", "definition").agg(F.min("merged_until").alias("until")).collect():
            merged_until[row.control, row.definition] = row.until
    parts = []
    for spec in derived:
        source = table(spec.source)
        name = definition(source, spec)
        until = None if spec.control in rebuild else merged_until.get((spec.control, name))
        after = None if until is None else min(until, merged) - dt.timedelta(days=late_days)
        rows = extended_keys(known, source, spec, after)
        parts.append(rows.select(*KEYS, F.lit(name).alias("definition"), F.lit(max(merged, until or merged)).alias("merged_until")))
    if not parts:
        parts = [spark.createDataFrame([], "control string, metric_detail string, metric string, definition string, merged_until date")]
    replace_table(reduce(DataFrame.unionByName, parts), target)


def refresh_metadata(spark: SparkSession, schemas: Sequence[str], target: str) -> None:
    """Replaces the stored ``target`` (dataset_id, table_id, last_modified_time) by what the catalog's ``schemas`` hold now."""
    replace_table(table_metadata(spark, schemas), target)


def define_refresh_view(spark: SparkSession, mapping: Sequence[RefreshSource], metadata: str | None, view: str) -> None:
    """Defines the freshness view over the stored ``metadata`` table (dataset_id, table_id, last_modified_time).

    Without one, the view asks the mapped tables themselves for the times of their files whenever it is read. A mapped view counts as
    the tables it reads. What a view reads is found when this is called; define the view again after views or
    names have changed. Mapped tables that don't exist then have no time.
    """
    if metadata is not None:
        replace_view(spark, view, refresh_select(mapping, metadata))
        return
    live = live_metadata_select(spark, [(m.dataset_id, m.table_id) for m in mapping])
    replace_view(spark, view, refresh_select(mapping, f"({live})"))


def refresh_unified(
    spark: SparkSession,
    specs: Sequence[ControlSpec],
    scaffold_table: str,
    refresh_view: str,
    target: str,
    as_of: dt.date | None = None,
    tables: Tables | None = None,
) -> None:
    """Rebuilds the unified table on the stored scaffold.

    Of the refresh view, the rows of the given controls are used, one for each.

    The scan bounds come from the days the scaffold really holds, so a run that falls between
    midnight and the next scaffold refresh still counts every day it reports.
    """
    grid = spark.table(scaffold_table)
    as_of = resolve_as_of(spark, as_of)
    counts = control_counts(spark, specs, as_of, tables=tables, scaffold=grid, span=stored_span(grid, as_of))
    names = [spec.control for spec in specs]
    times = spark.table(refresh_view).where(F.col("control").isin(*names))
    times = times.groupBy("control").agg(F.max("last_refresh_time").alias("last_refresh_time"))
    rows = attach_refresh(period_change(counts), times, len(names))
    replace_table(rows.select(*UNIFIED), target)


def stored_span(grid: DataFrame, as_of: dt.date) -> DateSpan:
    """First and last day of a stored scaffold (the day before ``as_of`` if it is empty)."""
    first, last = grid.agg(F.min("control_date"), F.max("control_date")).first()
    return DateSpan.before(as_of, 1) if first is None else DateSpan(first, last)
