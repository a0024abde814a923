"""Stored tables, views and freshness."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tallygrid import ControlSpec, RefreshSource, Rule, file_refresh_times, refresh_times, resolve_as_of, unified
from tallygrid.operators.freshness import BROADCAST_ROWS, attach_refresh
from tallygrid.plans.jobs import define_refresh_view, refresh_scaffold, refresh_unified, stored_span
from tallygrid.plans.unified import UNIFIED
from tallygrid.sinks import tables
from tallygrid.sinks.tables import replace_table, replace_view
from tallygrid.sources.tables import catalog_tables
from tests.helpers import AS_OF, day, plan_text

NOON = dt.datetime(2024, 6, 10, 12, 0, 0, 123000)
MILLIS = 1718020800123
METADATA = "dataset_id string, table_id string, last_modified_time bigint"


def controls():
    return [
        ControlSpec("plain", "incident_rows", "d", [Rule("m", F.col("k"))], [("m", "a"), ("m", "b")]),
        ControlSpec("it's", "incident_rows", "d", [Rule("m", "x")], [("m", "x")]),
    ]


MAPPING = [RefreshSource("plain", "ds", "tab"), RefreshSource("it's", "ds", "Tab"), RefreshSource("unused", "ds", "tab")]


@pytest.fixture
def stored(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS monitor")
    rows = spark.createDataFrame([(day(1), "a"), (day(2), "b"), (day(2), "b")], "d date, k string")
    replace_table(rows, "monitor.incident_rows")
    replace_table(spark.createDataFrame([("ds", "tab", MILLIS), ("other", "tab", 1)], METADATA), "monitor.metadata")
    yield catalog_tables(spark, "monitor")
    spark.sql("DROP DATABASE monitor CASCADE")


def test_stored_refreshes_equal_the_direct_plan(spark, stored):
    refresh_scaffold(spark, controls(), "monitor.scaffold", AS_OF, tables=stored)
    define_refresh_view(spark, MAPPING, "monitor.metadata", "monitor.refresh")
    refresh_unified(spark, controls(), "monitor.scaffold", "monitor.refresh", "monitor.unified", AS_OF, stored)
    table = spark.table("monitor.unified")
    assert table.columns == list(UNIFIED)
    direct = unified(spark, controls(), AS_OF, tables=stored, mapping=MAPPING, metadata=spark.table("monitor.metadata"))
    assert sorted(table.collect(), key=str) == sorted(direct.collect(), key=str)
    assert table.count() == 15
    assert {(r.control, r.last_refresh_time) for r in table.collect()} == {("plain", NOON), ("it's", None)}
    assert {t.name for t in spark.catalog.listTables("monitor")} == {
        "incident_rows",
        "metadata",
        "scaffold",
        "refresh",
        "unified",
    }


def test_counts_follow_the_days_of_the_stored_scaffold(spark, stored):
    """After midnight the scaffold is still yesterday's until its own refresh."""
    refresh_scaffold(spark, controls(), "monitor.scaffold", AS_OF, tables=stored)
    define_refresh_view(spark, MAPPING, "monitor.metadata", "monitor.refresh")
    later = AS_OF + dt.timedelta(days=1)
    refresh_unified(spark, controls(), "monitor.scaffold", "monitor.refresh", "monitor.unified", later, stored)
    first = spark.table("monitor.unified").where(F.col("control_date") == day(1)).where("metric_detail = 'a'").first()
    assert first.control_count == 1


def test_scaffold_rows_of_unknown_controls_are_left_out(spark, stored):
    refresh_scaffold(spark, controls(), "monitor.scaffold", AS_OF, tables=stored)
    define_refresh_view(spark, MAPPING, "monitor.metadata", "monitor.refresh")
    refresh_unified(spark, controls()[:1], "monitor.scaffold", "monitor.refresh", "monitor.unified", AS_OF, stored)
    assert {r.control for r in spark.table("monitor.unified").collect()} == {"plain"}


def test_view_is_evaluated_on_read(spark, stored):
    define_refresh_view(spark, MAPPING, "monitor.metadata", "monitor.refresh")
    before = spark.table("monitor.refresh").where("control = 'plain'").first().last_refresh_time
    replace_table(spark.createDataFrame([("ds", "tab", MILLIS + 1000)], METADATA), "monitor.metadata")
    after = spark.table("monitor.refresh").where("control = 'plain'").first().last_refresh_time
    assert (before, after) == (NOON, NOON + dt.timedelta(seconds=1))
    replace_view(spark, "monitor.refresh", "SELECT 1 AS one")
    assert spark.table("monitor.refresh").columns == ["one"]


def test_table_can_be_replaced_by_a_result_over_itself(spark, stored):
    replace_table(spark.table("monitor.incident_rows").where("k = 'b'"), "monitor.incident_rows")
    assert spark.table("monitor.incident_rows").count() == 2


def test_failed_write_leaves_the_old_table(spark, stored):
    broken = spark.table("monitor.incident_rows").select(F.raise_error(F.lit("no")).alias("d"))
    with pytest.raises(Exception, match="no"):
        replace_table(broken, "monitor.incident_rows")
    assert spark.table("monitor.incident_rows").count() == 3
    assert "incident_rows" in {t.name for t in spark.catalog.listTables("monitor")}


def names(spark):
    return {t.name for t in spark.catalog.listTables("monitor")}


def versions(spark, table):
    """Files and folders beside the table: its versions and claims."""
    state = spark._jsparkSession.sessionState()
    usual = state.catalog().defaultTablePath(state.sqlParser().parseTableIdentifier(table)).toString().removeprefix("file:")
    held = os.listdir(f"{usual}__versions") if os.path.isdir(f"{usual}__versions") else []
    return sorted(name for name in held if not name.startswith("."))  # the local file system's checksums


@pytest.fixture
def failing(spark, monkeypatch):
    """Makes the first SQL statement that holds a text fail, before or after it is run."""

    def arm(text, after=False):
        run, state = type(spark).sql, {"armed": True}

        def sql(self, query, *args, **more):
            if state["armed"] and text in query:
                state["armed"] = False
                if after:
                    run(self, query, *args, **more)
                raise ValueError("lost")
            return run(self, query, *args, **more)

        monkeypatch.setattr(type(spark), "sql", sql)

    return arm


@pytest.mark.parametrize("columns", [(), ("part",), ("part", "half")])
def test_replaced_tables_read_back_all_rows(spark, stored, columns):
    rows = spark.range(8).selectExpr("id", "CAST(id % 2 AS INT) AS part", "IF(id % 4 = 3, NULL, CONCAT('0', id % 4)) AS half")
    for n in (8, 5, 3):
        replace_table(rows.where(F.col("id") < n), "monitor.parted", columns)
        table = spark.table("monitor.parted").select("id", "part", "half")
        assert sorted(map(tuple, table.collect())) == sorted(map(tuple, rows.where(F.col("id") < n).collect()))
        assert tuple(c.name for c in spark.catalog.listColumns("monitor.parted") if c.isPartition) == columns
    # The version before is left for readers that have begun; the first one is gone.
    assert len(versions(spark, "monitor.parted")) == 2
    replace_table(rows.where("false"), "monitor.parted")
    assert spark.table("monitor.parted").count() == 0
    replace_table(rows, "monitor.parted")
    assert spark.table("monitor.parted").where("part = 1").count() == 4


def test_readers_that_have_begun_end_on_the_old_rows(spark, stored):
    replace_table(spark.range(3), "monitor.read")
    begun = spark.table("monitor.read")
    assert begun.count() == 3
    replace_table(spark.range(5), "monitor.read")
    assert begun.count() == 3
    assert spark.table("monitor.read").count() == 5


def test_replacing_keeps_partitions_and_properties(spark, stored):
    """Also of a table that was made without this library, with its partitions in the catalog."""
    rows = spark.range(4).selectExpr("id", "CAST(id % 2 AS INT) AS part")
    rows.write.partitionBy("part").saveAsTable("monitor.parted")
    spark.sql("ALTER TABLE monitor.parted SET TBLPROPERTIES ('keeper' = 'it\\'s')")
    for least in (2, 1):
        replace_table(rows.where(F.col("id") >= least), "monitor.parted")
        assert [c.name for c in spark.catalog.listColumns("monitor.parted") if c.isPartition] == ["part"]
        assert {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES monitor.parted").collect()}["keeper"] == "it's"
        assert spark.table("monitor.parted").count() == 4 - least
    assert "parted" in names(spark) and not [n for n in names(spark) if "__" in n]


def test_columns_may_change(spark, stored):
    replace_table(spark.range(3), "monitor.changing")
    replace_table(spark.range(2).selectExpr("id AS b", "'x' AS a"), "monitor.changing")
    assert spark.table("monitor.changing").columns == ["b", "a"]
    assert spark.table("monitor.changing").count() == 2
    assert not [n for n in names(spark) if "__" in n]


@pytest.mark.parametrize(("text", "after"), [("SET LOCATION", False), ("SET LOCATION", True)])
def test_fault_while_pointing_at_the_new_version(spark, stored, failing, text, after):
    replace_table(spark.range(4).selectExpr("id", "id % 2 AS part"), "monitor.swapped", ["part"])
    failing(text, after)
    with pytest.raises(ValueError, match="lost"):
        replace_table(spark.range(6).selectExpr("id", "id % 2 AS part"), "monitor.swapped")
    spark.catalog.refreshTable("monitor.swapped")
    assert spark.table("monitor.swapped").count() == (6 if after else 4)
    assert len(versions(spark, "monitor.swapped")) == (2 if after else 1)
    replace_table(spark.range(8).selectExpr("id", "id % 2 AS part"), "monitor.swapped")
    assert spark.table("monitor.swapped").count() == 8


@pytest.mark.parametrize(
    ("text", "after"),
    [("CREATE TABLE", False), ("CREATE TABLE", True), ("SET TBLPROPERTIES", False), ("__old_", False), ("RENAME TO `monitor`.`swapped`", False)],
)
def test_fault_while_names_change(spark, stored, failing, text, after):
    spark.range(4).selectExpr("id", "id % 2 AS part").write.partitionBy("part").saveAsTable("monitor.swapped")
    spark.sql("ALTER TABLE monitor.swapped SET TBLPROPERTIES ('keeper' = 'yes')")
    failing(text, after)
    with pytest.raises(ValueError, match="lost"):
        replace_table(spark.range(6).selectExpr("id", "id % 2 AS part"), "monitor.swapped")
    assert spark.table("monitor.swapped").count() == 4
    assert not [n for n in names(spark) if "__" in n]
    assert versions(spark, "monitor.swapped") == []
    replace_table(spark.range(8).selectExpr("id", "id % 2 AS part"), "monitor.swapped")
    assert spark.table("monitor.swapped").count() == 8


def test_of_two_replacements_one_wins(spark, stored, monkeypatch):
    """The second one is begun and ended while the first one writes."""
    replace_table(spark.range(2), "monitor.raced")
    begun = tables._stored

    def late(session, target):
        found = begun(session, target)
        monkeypatch.setattr(tables, "_stored", begun)
        replace_table(spark.range(7), "monitor.raced")
        return found

    monkeypatch.setattr(tables, "_stored", late)
    with pytest.raises(tables.ConcurrentReplacement):
        replace_table(spark.range(3), "monitor.raced")
    assert spark.table("monitor.raced").count() == 7
    assert len(versions(spark, "monitor.raced")) == 2
    assert not [n for n in names(spark) if "__" in n]


def test_a_claimed_version_is_not_replaced_by_others(spark, stored, monkeypatch):
    replace_table(spark.range(2), "monitor.raced")
    base = tables._versions(spark, "`monitor`.`raced`")
    with tables._claimed(spark, base, tables._stored(spark, "`monitor`.`raced`").location):
        with pytest.raises(tables.ConcurrentReplacement):
            replace_table(spark.range(3), "monitor.raced")
        assert spark.table("monitor.raced").count() == 2
        assert len(versions(spark, "monitor.raced")) == 2  # the version and the claim on it
        # The claim of a driver that was lost ends some time.
        monkeypatch.setattr(tables, "CLAIM_SECONDS", -1)
        replace_table(spark.range(4), "monitor.raced")
    assert spark.table("monitor.raced").count() == 4


def test_names_that_need_quotes_can_be_replaced(spark, stored):
    for name in ("monitor.`select`", "monitor.`1t`"):
        for n in (2, 3):
            replace_table(spark.range(n), name)
        assert spark.table(name).count() == 3
        replace_view(spark, f"{name[:-1]}_view`", f"SELECT * FROM {name}")
        assert spark.table(f"{name[:-1]}_view`").count() == 3


def test_lookup_beyond_the_bound_does_not_rest_on_one_key(spark):
    rows = spark.range(50).selectExpr("'a' AS control", "id")
    times = spark.createDataFrame([("a", NOON)], "control string, last_refresh_time timestamp")
    joined = attach_refresh(rows, times, BROADCAST_ROWS + 1)
    assert joined.columns == ["control", "id", "last_refresh_time"]
    assert joined.where("last_refresh_time IS NOT NULL").count() == 50
    assert "_salt" in plan_text(joined)


@pytest.mark.parametrize("zone", ["+02:00", "Asia/Tokyo", "UTC"])
def test_today_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert resolve_as_of(spark) == spark.range(1).select(F.current_date()).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_partitioned_table_is_read_by_name(spark, stored):
    refresh_scaffold(spark, controls(), "monitor.scaffold", AS_OF, tables=stored)
    spark.table("monitor.scaffold").write.partitionBy("control").saveAsTable("monitor.by_control")
    assert spark.table("monitor.by_control").columns[-1] == "control"
    define_refresh_view(spark, MAPPING, "monitor.metadata", "monitor.refresh")
    refresh_unified(spark, controls(), "monitor.by_control", "monitor.refresh", "monitor.unified", AS_OF, stored)
    assert spark.table("monitor.unified").agg(F.sum("control_count")).first()[0] == 6


def test_empty_scaffold_gives_an_empty_result(spark, stored):
    refresh_scaffold(spark, controls(), "monitor.scaffold", AS_OF, tables=stored)
    replace_table(spark.table("monitor.scaffold").where("false"), "monitor.scaffold")
    assert stored_span(spark.table("monitor.scaffold"), AS_OF).last == AS_OF - dt.timedelta(days=1)
    define_refresh_view(spark, MAPPING, "monitor.metadata", "monitor.refresh")
    refresh_unified(spark, controls(), "monitor.scaffold", "monitor.refresh", "monitor.unified", AS_OF, stored)
    assert spark.table("monitor.unified").count() == 0


def test_missing_and_differently_spelled_tables_have_no_time(spark):
    metadata = spark.createDataFrame([("ds", "tab", MILLIS)], METADATA)
    rows = {tuple(r) for r in refresh_times(spark, MAPPING, metadata).collect()}
    assert rows == {("plain", NOON), ("unused", NOON)}


def test_lookup_keeps_rows_without_a_match(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "control string, n int")
    right = spark.createDataFrame([("a", NOON)], "control string, last_refresh_time timestamp")
    rows = {(r.control, r.n, r.last_refresh_time) for r in attach_refresh(left, right, 1).collect()}
    assert rows == {("a", 1, NOON), ("a", 2, NOON), ("b", 3, None)}


@pytest.mark.parametrize(("bound", "hinted"), [(1, True), (BROADCAST_ROWS, True), (BROADCAST_ROWS + 1, False), (None, False)])
def test_lookup_side_is_broadcast_only_within_its_bound(spark, bound, hinted):
    left = spark.range(10).select(F.col("id").cast("string").alias("control"))
    right = left.withColumn("last_refresh_time", F.lit(NOON))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert ("BroadcastHashJoin" in plan_text(attach_refresh(left, right, bound))) is hinted
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_file_times(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(10).withColumn("part", F.col("id") % 3).write.partitionBy("part").parquet(str(path))
    files = sorted(path.rglob("*.parquet"))
    for i, file in enumerate(files):
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))
    df = file_refresh_times(spark, {"c": str(path), "d": str(path)})
    newest = dt.datetime(2023, 11, 14, 22, 13, 20) + dt.timedelta(seconds=len(files) - 1)
    assert {tuple(r) for r in df.collect()} == {("c", newest), ("d", newest)}
    assert "content" not in plan_text(df)
    assert plan_text(df).split("== Initial Plan ==")[0].count("FileScan") == 1
    (tmp_path / "empty").mkdir()
    assert file_refresh_times(spark, {"e": str(tmp_path / "empty")}).collect() == []


def test_without_metadata_the_time_is_null(spark):
    tables = {"incident_rows": spark.createDataFrame([(day(1), "a")], "d date, k string")}
    df = unified(spark, controls(), AS_OF, tables=tables)
    assert df.columns == list(UNIFIED)
    assert dict(df.dtypes)["last_refresh_time"] == "timestamp"
    assert df.where("last_refresh_time IS NOT NULL").count() == 0


def test_as_of_defaults_to_today_in_the_session_zone(spark):
    today = spark.sql("SELECT current_date()").first()[0]
    assert resolve_as_of(spark) in (today, today + dt.timedelta(days=1))
    assert resolve_as_of(spark, AS_OF) == AS_OF
