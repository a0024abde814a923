"""Key registry and refresh of changed days: equal to the whole-history forms after appends and corrections."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tallygrid import ControlSpec, KeysOf, Rule, control_counts, metric_grid, same_month
from tallygrid.operators.keys import extended_keys, key_rows
from tallygrid.plans.changed_days import refresh_changed
from tallygrid.plans.jobs import define_refresh_view, refresh_keys, refresh_scaffold, refresh_unified
from tallygrid.sources.tables import catalog_tables
from tests.helpers import AS_OF, final_plan, plan_text

ROWS = "id bigint, kind string, a bigint, b bigint, d date"


def key_control(name="K", detail=None):
    return ControlSpec(
        name,
        "facts",
        "d",
        [Rule("a", F.col("kind"), when=F.col("a").isNotNull(), measure=F.col("a"))],
        KeysOf(F.col("kind") if detail is None else detail, {"a": F.col("a"), "b": F.col("b"), "always": None}),
    )


@pytest.fixture
def lake(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS grown")
    spark.createDataFrame([], ROWS).write.partitionBy("d").saveAsTable("grown.facts")
    yield catalog_tables(spark, "grown")
    spark.sql("DROP DATABASE grown CASCADE")


def append(spark, rows, table="grown.facts"):
    spark.createDataFrame(rows, ROWS).write.partitionBy("d").mode("append").saveAsTable(table)


def rows_of(rng, day, n, kinds="abcd"):
    return [
        (i, rng.choice([*kinds, None]), rng.choice([None, 1, 2, -3]), rng.choice([None, None, 5]) if day > AS_OF - dt.timedelta(days=2) else None, day)
        for i in range(n)
    ]


def cells(rows):
    return sorted(map(str, rows.select("control", "metric", "metric_detail").collect()))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_registry_equals_the_whole_history(spark, lake, seed):
    rng = random.Random(seed)
    specs = [key_control(), ControlSpec("S", "facts", "d", [Rule("m", "x")], [("m", "x")])]
    for step in range(4):
        as_of = AS_OF + dt.timedelta(days=step)
        rows = rows_of(rng, as_of - dt.timedelta(days=1), 6, "abcdefgh"[: step * 2 + 1])
        # Today's rows and those of no day are read again next time.
        append(spark, [*rows, (0, f"today {step}", None, None, as_of), (0, f"undated {step}", None, 1, None)])
        refresh_keys(spark, specs, "grown.keys", as_of, lake)
        grid = metric_grid(spark, specs, lake, spark.table("grown.keys"))
        assert cells(grid) == cells(metric_grid(spark, specs, lake))
        assert len(cells(grid)) == len(set(cells(grid)))
    refresh_scaffold(spark, specs, "grown.by_keys", as_of, tables=lake, keys="grown.keys")
    refresh_scaffold(spark, specs, "grown.by_history", as_of, tables=lake)
    assert spark.table("grown.by_keys").exceptAll(spark.table("grown.by_history")).count() == 0
    assert spark.table("grown.by_history").exceptAll(spark.table("grown.by_keys")).count() == 0


def test_late_rows_rebuilds_and_new_definitions(spark, lake):
    append(spark, [(1, "old", 1, None, AS_OF - dt.timedelta(days=9))])
    refresh_keys(spark, [key_control()], "grown.keys", AS_OF, lake)
    append(spark, [(2, "late", 1, None, AS_OF - dt.timedelta(days=3))])
    details = lambda: {r.metric_detail for r in spark.table("grown.keys").where("control = 'K'").collect()}
    refresh_keys(spark, [key_control()], "grown.keys", AS_OF, lake)
    assert details() == {"old"}
    refresh_keys(spark, [key_control()], "grown.keys", AS_OF, lake, late_days=3)
    assert details() == {"old", "late"}
    append(spark, [(3, "very late", 1, None, AS_OF - dt.timedelta(days=30))])
    refresh_keys(spark, [key_control()], "grown.keys", AS_OF, lake, rebuild={"K"})
    assert details() == {"old", "late", "very late"}
    refresh_keys(spark, [key_control(detail=F.upper("kind"))], "grown.keys", AS_OF, lake)
    assert details() == {"OLD", "LATE", "VERY LATE"}
    refresh_keys(spark, [ControlSpec("S", "facts", "d", [Rule("m", "x")], [("m", "x")])], "grown.keys", AS_OF, lake)
    assert spark.table("grown.keys").count() == 0


def test_only_new_days_are_read(spark, lake):
    append(spark, [(1, "a", 1, None, AS_OF - dt.timedelta(days=n)) for n in range(1, 9)])
    source = lake("facts")
    known = key_rows(source, key_control())
    known.write.saveAsTable("grown.known")
    text = plan_text(extended_keys(spark.table("grown.known"), source, key_control(), AS_OF - dt.timedelta(days=3)))
    assert re.search(r"PartitionFilters: \[.*d#\d+ > 2024-06-08", text)
    assert text.count("FileScan") == 2  # the registry, and the new days


def test_keys_and_counts_come_from_one_scan(spark, lake):
    append(spark, rows_of(random.Random(4), AS_OF - dt.timedelta(days=1), 30) + rows_of(random.Random(5), AS_OF - dt.timedelta(days=40), 30, "xyz"))
    counts = control_counts(spark, [key_control()], AS_OF, tables=lake)
    found = {(r.control_date, r.metric, r.metric_detail): r.control_count for r in counts.collect()}
    # The other uses, one of them in the subquery for the metrics, take what the first one has shuffled.
    assert final_plan(counts).count("FileScan") == 1
    assert "ReusedExchange" in final_plan(counts)
    rows = lake("facts").collect()
    details = {r.kind for r in rows}
    days = [AS_OF - dt.timedelta(days=n) for n in range(1, 6)]
    metrics = ["a", "always"] + ["b"] * any(r.b is not None for r in rows)
    assert found == {
        (day, metric, detail): sum(r.a for r in rows if metric == "a" and detail is not None and r.kind == detail and r.d == day and r.a is not None)
        for day in days
        for metric in metrics
        for detail in details
    }


def unified_controls():
    return [
        ControlSpec("cells", "facts", "d", [Rule("m", F.col("kind"))], [("m", k) for k in "abc"]),
        ControlSpec("sums", "facts", "d", [Rule("m", "x", measure=F.col("a"))], [("m", "x")]),
        ControlSpec("sparse", "facts", "d", [Rule("m", F.col("kind"))], [("m", k) for k in "abcd"], zero_fill=False),
        ControlSpec("month", "facts", "d", [Rule("m", "x", when=lambda as_of: same_month(F.col("d"), as_of))], [("m", "x")]),
        ControlSpec("plain", "flat", "at", [Rule("m", "x", when=F.col("n") > 1)], [("m", "x")]),
        key_control("keys"),
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_changed_days_equal_the_full_rebuild(spark, lake, seed):
    rng = random.Random(seed)
    spark.sql("CREATE TABLE grown.flat (at DATE, n INT) USING parquet")
    specs = unified_controls()
    define_refresh_view(spark, [], None, "grown.refresh")
    start = dt.date(2024, 6, 28)  # the month turns
    for n in range(8):
        append(spark, rows_of(rng, start - dt.timedelta(days=n + 1), rng.choice([0, 3, 5])) or [(0, "z", None, None, start - dt.timedelta(days=n + 1))])
    seen = []
    for step in range(6):
        as_of = start + dt.timedelta(days=step // 2)
        if step % 2 == 0:
            append(spark, rows_of(rng, as_of - dt.timedelta(days=1), 4))
        if step in (1, 3):
            corrected = as_of - dt.timedelta(days=3)
            spark.sql(f"ALTER TABLE grown.facts DROP IF EXISTS PARTITION (d = DATE'{corrected}')")
            if step == 3:
                append(spark, rows_of(rng, corrected, 5))
        if step == 4:
            spark.sql(f"INSERT INTO grown.flat VALUES (DATE'{as_of - dt.timedelta(days=2)}', 7)")
        refresh_scaffold(spark, specs, "grown.scaffold", as_of, tables=lake)
        again = refresh_changed(spark, specs, "grown.scaffold", "grown.refresh", "grown.unified", "grown.states", as_of, lake, "grown")
        refresh_unified(spark, specs, "grown.scaffold", "grown.refresh", "grown.full", as_of, lake)
        left, right = spark.table("grown.unified"), spark.table("grown.full")
        assert sorted(map(str, left.collect())) == sorted(map(str, right.collect()))
        seen.append({name: len(days) for name, days in again.items()})
    assert seen[0]["cells"] == 5
    assert all(step["cells"] < 5 for step in seen[1:] if "cells" in step)
    assert seen[5].keys() == {"month"}
    assert seen[4]["plain"] == 5
