"""Refresh of the unified table that counts again only the days whose source files have changed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.functions.dates import DateSpan, resolve_as_of
from tallygrid.operators.change import period_change
from tallygrid.operators.counts import grid_counts
from tallygrid.operators.freshness import attach_refresh
from tallygrid.operators.incidents import incidents
from tallygrid.plans.unified import UNIFIED
from tallygrid.sinks.tables import replace_table
from tallygrid.sources.metadata import base_relations
from tallygrid.sources.tables import Tables, lookup
from tallygrid.spec import CELL, ControlSpec, checked

#: Files of one source and day; no day where the folders don't tell it.
STATES = "source string, control_date date, files bigint, bytes bigint, newest bigint"


def day_states(spark: SparkSession, sources: dict[str, tuple[str, str]]) -> DataFrame:
    """(source, control_date, files, bytes, newest in ms) from the listing of the files behind each source.

    ``sources`` maps a source to its table or view and its date column. Files below a folder ``<date column>=<day>`` belong
    to that day; all others to no day, and a change of theirs touches all days. Contents are not opened. One listing of each folder.
    """
    parts = [spark.createDataFrame([], STATES)]
    for source, (table, date) in sources.items():
        for base in base_relations(spark, table) or ():
            for folder in base.folders:
                files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
                day = F.try_to_date(F.regexp_extract("path", f"(?i)/\\Q{date}\\E=([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})/", 1), "yyyy-MM-dd")
                parts.append(
                    files.select(F.lit(source).alias("source"), day.alias("control_date"), "length", F.unix_millis("modificationTime").alias("at"))
                    .groupBy("source", "control_date")
                    .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max("at").alias("newest"))
                )
    return reduce(DataFrame.unionByName, parts)


def changed_days(before: DataFrame, now: DataFrame) -> DataFrame:
    """(source, control_date) of the days whose files were added, written anew or removed."""
    columns = ["source", "control_date", "files", "bytes", "newest"]
    tagged = before.select(*columns, F.lit(-1).alias("side")).unionByName(now.select(*columns, F.lit(1).alias("side")))
    # A state that both sides hold adds up to nothing. Views may list a folder twice, alike on both sides.
    return tagged.groupBy(*columns).agg(F.sum("side").alias("left")).where("left <> 0").select("source", "control_date").distinct()


def refresh_changed(
    spark: SparkSession,
    specs: Sequence[ControlSpec],
    scaffold_table: str,
    refresh_view: str,
    target: str,
    states_table: str,
    as_of: dt.date | None = None,
    tables: Tables | None = None,
    home: str | None = None,
) -> dict[str, list[dt.date]]:
    """Brings ``target`` to what ``refresh_unified`` would make of it; returns the days counted again, by control.

    Days of the stored scaffold are counted again where the files of the control's source have changed since the last
    run (kept in ``states_table``), or where the target has no row of the control and day yet. All days are for controls whose
    conditions depend on the day of the run, whose source tells no days by its folders and has changed, or whose number of stored
    days is none. Other counts are taken from the target; cells that are new on such days count 0. The changes against the
    day before are worked out over all days anew, so the day after a corrected one is right too.

    What isn't noticed: a new definition of a control under its old id; drop the target then. ``home`` is the schema of bare source names.
    """
    specs = checked(specs)
    as_of = resolve_as_of(spark, as_of)
    table = lookup(spark, tables)
    grid = spark.table(scaffold_table).where(F.col("control").isin(*[spec.control for spec in specs]))
    names = {s.source: s.source if home is None or "." in s.source else f"{home}.{s.source}" for s in specs}
    states = day_states(spark, {s.source: (names[s.source], s.date) for s in specs})
    stored = spark.table(target) if spark.catalog.tableExists(target) else None
    again: dict[str, list[dt.date]] = {}
    # One row for each control and day of the scaffold, of each source and changed day, of each control and stored day.
    expected: dict[str, set[dt.date]] = {}
    for control, day in grid.select("control", "control_date").distinct().collect():
        expected.setdefault(control, set()).add(day)
    changed: dict[str, set[dt.date | None]] = {}
    if stored is not None and spark.catalog.tableExists(states_table):
        for source, day in changed_days(spark.table(states_table), states).collect():
            changed.setdefault(source, set()).add(day)
        held: dict[str, set[dt.date]] = {}
        for control, day in stored.select("control", "control_date").distinct().collect():
            held.setdefault(control, set()).add(day)
    else:
        held = {}
    every = {day for days in held.values() for day in days}
    for spec in specs:
        days, own = expected.get(spec.control, set()), changed.get(spec.source, set())
        if not held.get(spec.control) or None in own or any(callable(rule.when) and not hasattr(rule.when, "_jc") for rule in spec.rules):
            chosen = days
        else:
            # Quiet days of sparse controls have no rows; new ones lie outside the days of all controls.
            new = {d for d in days if d not in held[spec.control] and (spec.zero_fill or not min(every) <= d <= max(every))}
            chosen = (days & own) | new
        if chosen:
            again[spec.control] = sorted(chosen)
    found = []
    for first, last_day, own in _runs(specs, again):
        found.append(incidents(spark, own, DateSpan(first, last_day), as_of, table))
    if stored is not None:
        kept = stored.where(~_counted_again(again)).select(*CELL, F.col("control_count").alias("weight"), F.lit(1).cast("bigint").alias("hits"))
        found.append(kept)
    if not found:
        found = [spark.createDataFrame([], "control string, control_date date, metric string, metric_detail string, weight bigint, hits bigint")]
    sparse = {spec.control for spec in specs if not spec.zero_fill}
    counts = grid_counts(grid, reduce(DataFrame.unionByName, found), sparse)
    ids = [spec.control for spec in specs]
    times = spark.table(refresh_view).where(F.col("control").isin(*ids))
    times = times.groupBy("control").agg(F.max("last_refresh_time").alias("last_refresh_time"))
    replace_table(attach_refresh(period_change(counts), times, len(ids)).select(*UNIFIED), target)
    replace_table(states, states_table)
    return again


def _runs(specs: Sequence[ControlSpec], again: dict[str, list[dt.date]]) -> list[tuple[dt.date, dt.date, list[ControlSpec]]]:
    """Runs of consecutive days with the controls that are counted again on all of them; controls with the same days together."""
    by_days: dict[tuple[dt.date, ...], list[ControlSpec]] = {}
    for spec in specs:
        if spec.control in again:
            by_days.setdefault(tuple(again[spec.control]), []).append(spec)
    out = []
    for days, own in by_days.items():
        first = previous = days[0]
        for day in [*days[1:], None]:
            if day is None or day - previous > dt.timedelta(days=1):
                out.append((first, previous, own))
                first = day
            previous = day
    return out


def _counted_again(again: dict[str, list[dt.date]]):
    """Rows whose counts are taken anew. Days are named one by one: a span of thousands of days is a list of thousands of literals."""
    conditions = [(F.col("control") == control) & F.col("control_date").isin(*days) for control, days in again.items()]
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)
