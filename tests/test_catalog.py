"""The standard controls, and all registered queries against their SQL."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from checks.compare import difference, oracle_session
from checks.queries import registry
from tallygrid.plans.catalog import REFRESH_SOURCES, standard_controls, suspense_by_error
from tallygrid.plans.unified import UNIFIED

TINY = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


def test_active_controls(spark):
    controls = standard_controls()
    assert len(controls) == 15
    assert "F12-M" not in {c.control for c in controls}
    assert suspense_by_error().control == "F12-M"
    assert [c.control for c in controls if not c.zero_fill] == ["PR-1"]
    assert [c.control for c in controls if not c.static] == ["IME01-W", "IME02-W"]


def test_static_cells(spark):
    cells = Counter({c.control: len(c.grid) for c in standard_controls() if c.static})
    assert cells.total() == 85
    assert cells == {
        "A02-Q": 2,
        "A04-Q": 2,
        "A06-M": 2,
        "A15-Q": 1,
        "A17-M": 2,
        "CH-V": 1,
        "E05-W": 1,
        "F01-M": 3,
        "FC01-Q": 1,
        "GX4-JX": 1,
        "PR-1": 65,
        "VAR-1": 2,
        "X01-B": 2,
    }


def test_refresh_sources_cover_all_controls(spark):
    assert len(REFRESH_SOURCES) == 16
    active = {c.control for c in standard_controls()}
    assert {r.control for r in REFRESH_SOURCES} == active | {"F12-M"}


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == list(UNIFIED)
    # 20 static cells, 3 message ids (one of them NULL) and 3 measures of 6 portals, on five days.
    assert df.where("control <> 'PR-1'").count() == 5 * (20 + 3 + 18)


def test_keys_agree():
    """Of the queries that are there with and without the document operators."""
    assert registry().keys() <= entry_point.queries().keys()
    assert registry().keys() <= entry_point.oracle_sql().keys()
    assert entry_point.oracle_sql().keys() <= entry_point.queries().keys()


@pytest.fixture(scope="module")
def duck():
    return oracle_session(TINY)


@pytest.mark.parametrize("name", registry())
def test_query_equals_its_sql(spark, duck, name):
    query, sql = registry()[name]
    assert difference(query(spark, TINY), duck, sql) is None


@pytest.mark.parametrize("name", [n for n in registry() if n.endswith("_full") and n not in ("incidents_full",)])
def test_full_queries_count_something_in_every_control(spark, name):
    df = registry()[name][0](spark, SMALL)
    totals = df.groupBy("control").agg(F.max(F.abs("control_count")).alias("most"))
    quiet = {r.control for r in totals.collect() if not r.most}
    # The month of the last day of all tables holds no order.
    several = ("unified_full", "fused_shapes_full", "stored_scaffold_counts_full")
    assert quiet <= ({"A15-Q", "month_to_date_orders"} if name in several else set())
