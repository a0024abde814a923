"""The physical plans keep the properties that matter on large data."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from checks.queries import FULL, RECENT, unified_report
from checks.shapes import shapes
from tallygrid import ControlSpec, KeysOf, Rule, control_counts, metric_grid, period_change
from tallygrid.plans import catalog
from tallygrid.sources.local import literal_rows
from tallygrid.sources.tables import parquet_tables
from tests.helpers import plan_text

TINY = "/root/testdata/sf0.001"


def counted(spark, *names, window=RECENT):
    tables = parquet_tables(spark, TINY)
    return control_counts(spark, [shapes()[n] for n in names], *window, tables)


def test_change_uses_one_window_and_one_lag(spark):
    text = plan_text(period_change(counted(spark, "category_orders_ts")))
    assert len(re.findall(r"\+- Window ", text)) == 1
    assert text.count("lag(") == 1


def test_date_bounds_and_categories_reach_the_scan(spark, capsys):
    df = counted(spark, "category_orders_ts")
    df.explain("formatted")
    text = capsys.readouterr().out
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(o_orderdate" in pushed
    assert "LessThan(o_orderdate" in pushed
    assert "In(o_orderstatus, [F,P])" in pushed
    schema = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert re.findall(r"(o_\w+):", schema) == ["o_orderstatus", "o_orderdate"]


@pytest.mark.parametrize(
    ("control", "columns", "pushed"),
    [
        (
            catalog.leases,
            "contract_start_date date, billed_as_expected boolean, lease_cancelled boolean, "
            "wholesale_part_of_retail_lease boolean, lease_contract_number string, contract_value bigint",
            "Or(",
        ),
        (catalog.termination_fees, "billing_task_completed_on date, sap_net_value double, is_vessel_ooc string", "Or("),
        (catalog.variable_leases, "order_date date, category_1 string, billed_in_sv_category string", "Or("),
    ],
)
def test_conditions_of_several_rules_reach_the_scan(spark, tmp_path, control, columns, pushed):
    path = str(tmp_path / "rows")
    spark.createDataFrame([], columns).write.parquet(path)
    spec = control()
    df = control_counts(spark, [spec], dt.date(2024, 6, 11), tables={spec.source: spark.read.parquet(path)})
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")  # a plan's text cuts long filters short otherwise
    try:
        text = plan_text(df)
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", before)
    assert any(pushed in filters for filters in re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", text))


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_bounds_prune_for_every_date_type(spark, tmp_path, kind):
    path = str(tmp_path / kind)
    spark.sql(f"SELECT CAST('2024-06-09' AS {kind}) AS d").write.parquet(path)
    spec = ControlSpec("c", "t", "d", [Rule("m", "x")], [("m", "x")])
    df = control_counts(spark, [spec], dt.date(2024, 6, 11), tables={"t": spark.read.parquet(path)})
    pushed = re.search(r"PushedFilters: (\[[^]]*d,2024[^]]*\])", plan_text(df)).group(1)
    assert "GreaterThanOrEqual(d,2024-06-06" in pushed
    assert "LessThan" in pushed


def test_partitioned_source_is_pruned(spark, tmp_path):
    path = str(tmp_path / "by_day")
    days = spark.range(60).select(F.date_sub(F.lit(dt.date(2024, 6, 10)), F.col("id").cast("int")).alias("d"), "id")
    days.write.partitionBy("d").parquet(path)
    spec = ControlSpec("c", "t", "d", [Rule("m", "x")], [("m", "x")])
    df = control_counts(spark, [spec], dt.date(2024, 6, 11), tables={"t": spark.read.parquet(path)})
    assert re.search(r"PartitionFilters: \[[^]]*d#\d+ >= 2024-06-06", plan_text(df))
    assert df.agg(F.sum("control_count")).first()[0] == 5


def test_incidents_meet_the_grid_without_a_join(spark):
    text = plan_text(counted(spark, "category_orders_ts", "cell_open_lines", "sparse_orders", window=FULL))
    assert "Join" not in text
    assert "Cartesian" not in text
    assert "Broadcast" not in text


def test_single_rule_is_shuffled_once_and_collapsed_before(spark):
    text = plan_text(counted(spark, "category_orders_ts", window=FULL))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in text


def test_rules_of_one_source_share_a_scan(spark):
    names = [n for n, s in shapes().items() if s.source == "orders"]
    assert len(names) == 5
    text = plan_text(counted(spark, *names, window=FULL))
    assert text.count("FileScan") == 1


def test_rules_with_the_same_key_share_a_scan(spark):
    text = plan_text(counted(spark, "unpivot_measures_lines", window=FULL))
    # One for the counts, one for the keys, and one that the run replaces by reusing the latter.
    assert text.count("FileScan") == 3


def test_keys_of_a_source_are_read_once(spark):
    grid = metric_grid(spark, [shapes()["unpivot_measures_lines"]], parquet_tables(spark, TINY))
    assert {r.metric for r in grid.collect()} == {"files", "recs", "diff"}
    final = plan_text(grid).split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") == 1


def test_literal_rows_are_a_local_relation(spark):
    assert "LocalTableScan" in plan_text(literal_rows(spark, ["a", "b"], [("x", None)]))


def test_key_list_without_presence_test_is_a_plain_distinct(spark):
    spec = ControlSpec("c", "lineitem", "l_shipdate", [Rule("m", F.col("l_returnflag"))], KeysOf(F.col("l_returnflag"), {"m": None}))
    text = plan_text(metric_grid(spark, [spec], parquet_tables(spark, TINY)))
    assert "Subquery" not in text
    assert text.count("FileScan") == 1


def test_unified_reads_each_source_once_per_use(spark):
    text = plan_text(unified_report(spark, TINY, RECENT)).split("== Initial Plan ==")[0]
    assert "Cartesian" not in text
    assert "BroadcastNestedLoopJoin" not in text
