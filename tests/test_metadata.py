"""Freshness read from the catalog: tables, views, partitions elsewhere, missing tables."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from tallygrid import RefreshSource
from tallygrid.plans.jobs import define_refresh_view, refresh_metadata
from tallygrid.sinks.tables import replace_table
from tallygrid.sources.metadata import base_relations, table_metadata
from tests.helpers import plan_text

START = 1_700_000_000


@pytest.fixture
def schema(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS lake")
    yield "lake"
    spark.sql("DROP DATABASE lake CASCADE")


def touch(spark, table, seconds):
    """Sets the times of all files of a table, the newest ``seconds`` after START."""
    files = sorted(f.removeprefix("file:") for f in spark.table(table).inputFiles())
    for i, file in enumerate(reversed(files)):
        path = file.replace("//", "/").replace("%20", " ")
        os.utime(path, (START + seconds - i, START + seconds - i))
    spark.catalog.refreshTable(table)  # this session has listed the files before
    return len(files)


def times(rows):
    return {(r.dataset_id, r.table_id): r.last_modified_time // 1000 - START for r in rows.collect()}


@pytest.fixture
def tables(spark, schema):
    spark.range(20).repartition(3).write.saveAsTable("lake.flat")
    spark.range(20).selectExpr("id", "id % 3 AS part").write.partitionBy("part").saveAsTable("lake.parted")
    replace_table(spark.range(6).selectExpr("id", "id % 2 AS part"), "lake.replaced", ["part"])
    for table, seconds in (("lake.flat", 100), ("lake.parted", 200), ("lake.replaced", 300)):
        assert touch(spark, table, seconds) > 1
    spark.sql("CREATE TABLE lake.empty (id BIGINT) USING parquet")


def test_times_of_tables(spark, tables):
    found = table_metadata(spark, ["lake", "lake", "no_such_schema"])
    assert times(found) == {("lake", "flat"): 100, ("lake", "parted"): 200, ("lake", "replaced"): 300}
    assert found.columns == ["dataset_id", "table_id", "last_modified_time"]
    assert dict(found.dtypes)["last_modified_time"] == "bigint"
    text = plan_text(found).split("== Initial Plan ==")[0]
    assert "content" not in text and text.count("FileScan") == 1
    assert table_metadata(spark, ["no_such_schema"]).count() == 0


def test_times_of_views(spark, tables):
    spark.sql("CREATE VIEW lake.both AS SELECT id FROM lake.flat UNION ALL SELECT id FROM lake.parted")
    spark.sql("CREATE VIEW lake.nested AS WITH x AS (SELECT * FROM lake.both) SELECT * FROM x WHERE id IN (SELECT id FROM lake.replaced)")
    spark.sql("CREATE VIEW lake.numbers AS SELECT id FROM range(3)")
    spark.range(3).write.saveAsTable("lake.gone")
    spark.sql("CREATE VIEW lake.broken AS SELECT * FROM lake.gone")
    spark.sql("DROP TABLE lake.gone")
    found = times(table_metadata(spark, ["lake"]))
    assert found["lake", "both"] == 200
    assert found["lake", "nested"] == 300
    assert not {("lake", "numbers"), ("lake", "broken"), ("lake", "empty")} & found.keys()
    assert base_relations(spark, "lake.broken") is None
    assert base_relations(spark, "lake.numbers") == []
    assert {b.name for b in base_relations(spark, "lake.nested")} == {"`spark_catalog`.`lake`.`" + t + "`" for t in ("flat", "parted", "replaced")}


def test_partitions_elsewhere_count(spark, tables, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "far away"))
    spark.sql(f"ALTER TABLE lake.parted ADD PARTITION (part = 9) LOCATION '{tmp_path / 'far away'}'")
    for file in (tmp_path / "far away").glob("*.parquet"):
        os.utime(file, (START + 900, START + 900))
    assert times(table_metadata(spark, ["lake"]))["lake", "parted"] == 900


MAPPING = [RefreshSource("A", "lake", "flat"), RefreshSource("it's", "lake", "both"), RefreshSource("C", "lake", "missing"), RefreshSource("D", "lake", "Flat")]


def at(seconds):
    return dt.datetime(2023, 11, 14, 22, 13, 20) + dt.timedelta(seconds=seconds)


def test_freshness_view_without_a_metadata_table(spark, tables):
    spark.sql("CREATE VIEW lake.both AS SELECT id FROM lake.flat UNION ALL SELECT id FROM lake.replaced")
    define_refresh_view(spark, MAPPING[:3], None, "lake.fresh")
    read = lambda: {tuple(r) for r in spark.table("lake.fresh").collect()}
    assert read() == {("A", at(100)), ("it's", at(300))}
    touch(spark, "lake.flat", 500)
    assert read() == {("A", at(500)), ("it's", at(500))}
    # A replaced table is read by its name, so the view goes to the new version.
    replace_table(spark.range(9).selectExpr("id", "id % 2 AS part"), "lake.replaced")
    assert dict(read())["it's"] > at(1000)
    define_refresh_view(spark, MAPPING[2:3], None, "lake.fresh")
    assert read() == set()


def test_freshness_view_over_stored_metadata(spark, tables):
    refresh_metadata(spark, ["lake"], "lake.stored_times")
    define_refresh_view(spark, MAPPING, "lake.stored_times", "lake.fresh")
    # The names in the metadata match case-sensitively.
    assert {tuple(r) for r in spark.table("lake.fresh").collect()} == {("A", at(100))}
