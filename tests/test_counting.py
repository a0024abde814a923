"""Hand-written expectations for the count semantics."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallygrid import (
    ControlSpec,
    DateSpan,
    KeysOf,
    Rule,
    control_counts,
    date_spine,
    grid_counts,
    incidents,
    metric_grid,
    period_change,
    same_month,
    scaffold,
    sparse_counts,
    unpivot_nonnull,
    unpivot_rules,
    zero_filled_counts,
)
from tallygrid.functions.conditions import null_or_zero
from tests.helpers import AS_OF, at, day, series


def counts(spark, spec, rows, schema, as_of=AS_OF):
    return control_counts(spark, [spec], as_of, tables={"t": spark.createDataFrame(rows, schema)})


def cell(when=None, **changes):
    return ControlSpec("c", "t", "d", [Rule("m", "x", when=when)], [("m", "x")], **changes)


def test_zero_fill_and_change(spark):
    df = period_change(counts(spark, cell(), [(day(2),)] * 3, "d date"))
    assert series(df) == {("m", "x"): [0, 3, 0, 0, 0]}
    assert series(df, "daily_absolute_change") == {("m", "x"): [None, 3, -3, 0, 0]}
    assert series(df, "daily_percent_change") == {("m", "x"): [None, None, -100.0, None, None]}


def test_sparse_gap_compares_with_last_day_that_has_a_row(spark):
    df = period_change(counts(spark, cell(zero_fill=False), [(day(1),)] * 2 + [(day(4),)] * 5, "d date"))
    assert [r.control_date for r in df.orderBy("control_date").collect()] == [day(1), day(4)]
    assert series(df, "daily_absolute_change") == {("m", "x"): [None, 3]}
    assert series(df, "daily_percent_change") == {("m", "x"): [None, 150.0]}


def test_sparse_keeps_a_cell_whose_hits_sum_to_nothing(spark):
    spec = ControlSpec("c", "t", "d", [Rule("m", "x", measure=F.col("v"))], [("m", "x")], zero_fill=False)
    df = counts(spark, spec, [(day(1), 2), (day(1), -2), (day(2), None)], "d date, v int")
    assert series(df) == {("m", "x"): [0, 0]}


def test_null_detail_in_derived_grid_never_matches(spark):
    spec = ControlSpec("c", "t", "d", [Rule("m", F.col("k"))], KeysOf(F.col("k"), {"m": None}))
    df = counts(spark, spec, [(day(1), None), (day(1), "a"), (day(2), None)], "d date, k string")
    assert series(df) == {("m", None): [0] * 5, ("m", "a"): [1, 0, 0, 0, 0]}


def test_derived_grid_comes_from_the_whole_history(spark):
    spec = ControlSpec("c", "t", "d", [Rule("m", F.col("k"))], KeysOf(F.col("k"), {"m": None}))
    df = counts(spark, spec, [(dt.date(1999, 1, 1), "old")], "d date, k string")
    assert series(df) == {("m", "old"): [0] * 5}


def test_integer_details_become_text(spark):
    spec = ControlSpec("c", "t", "d", [Rule("m", F.col("k"), measure=F.col("n"))], KeysOf(F.col("k"), {"m": None}))
    df = counts(spark, spec, [(day(1), 7, 2), (day(1), 7, 3)], "d date, k int, n int")
    assert series(df) == {("m", "7"): [5, 0, 0, 0, 0]}
    assert dict(df.dtypes)["control_count"] == "bigint"


def test_sum_of_only_nulls_is_zero(spark):
    spec = ControlSpec("c", "t", "d", [Rule("m", "x", measure=F.col("v"))], [("m", "x")])
    assert series(counts(spark, spec, [(day(1), None)], "d date, v int")) == {("m", "x"): [0] * 5}


def test_negative_sum(spark):
    spec = ControlSpec("c", "t", "d", [Rule("m", "x", measure=F.col("v"))], [("m", "x")])
    assert series(counts(spark, spec, [(day(3), 3), (day(3), -5)], "d date, v int"))[("m", "x")][2] == -2


@pytest.mark.parametrize(
    ("kind", "value", "expected", "result"),
    [("decimal(10,2)", Decimal("1.50"), Decimal("3.00"), "decimal"), ("double", 1.5, 3.0, "double")],
)
def test_count_column_widens_to_the_measure(spark, kind, value, expected, result):
    summed = ControlSpec("s", "t", "d", [Rule("m", "x", measure=F.col("v"))], [("m", "x")])
    tables = {"t": spark.createDataFrame([(day(1), value), (day(1), value)], f"d date, v {kind}")}
    df = control_counts(spark, [summed, cell()], AS_OF, tables=tables)
    first = {r.control: r.control_count for r in df.where(F.col("control_date") == day(1)).collect()}
    assert first == {"s": expected, "c": 2}
    assert dict(df.dtypes)["control_count"].startswith(result)


@pytest.mark.parametrize(("kind", "value"), [("decimal(12,2)", Decimal("0.10")), ("double", 0.25)])
def test_sums_depend_on_neither_neighbours_nor_list_length(spark, kind, value):
    rows = [(day(1), "k0", value), (day(1), "k0", value), (day(2), "k0", value)]
    tables = {"t": spark.createDataFrame(rows, f"d date, k string, v {kind}")}
    seen = set()
    for cells in (1, 16, 17):
        grid = [("m", f"k{i}") for i in range(cells)]
        summed = ControlSpec("s", "t", "d", [Rule("m", F.col("k"), measure=F.col("v"))], grid)
        for neighbours in ([], [cell()]):
            df = period_change(control_counts(spark, [summed, *neighbours], AS_OF, tables=tables))
            types = tuple(t for c, t in df.dtypes if c in ("control_count", "daily_absolute_change", "daily_percent_change"))
            found = df.where("control = 's' AND metric_detail = 'k0'").orderBy("control_date").collect()
            seen.add((types, tuple((r.control_count, r.daily_absolute_change, r.daily_percent_change) for r in found)))
    ((types, values),) = seen
    assert types == (("decimal(38,6)",) * 2 if "decimal" in kind else ("double",) * 2) + ("double",)
    assert [v[0] for v in values] == [2 * value, value, 0, 0, 0]
    assert [v[2] for v in values[:3]] == [None, -50.0, -100.0]


def test_null_in_condition_is_not_counted(spark):
    df = counts(spark, cell(F.col("s") != "Stopped"), [(day(1), None), (day(1), "Stopped"), (day(1), "On")], "d date, s string")
    assert series(df)[("m", "x")][0] == 1


def test_double_hit_counts_once_in_each_metric(spark):
    spec = ControlSpec(
        "c",
        "t",
        "d",
        [Rule("one", "n/a", when=F.col("a")), Rule("two", "n/a", when=F.col("b"))],
        [("one", "n/a"), ("two", "n/a")],
    )
    df = counts(spark, spec, [(day(1), True, True), (day(1), True, False), (day(1), None, True)], "d date, a boolean, b boolean")
    assert series(df) == {("one", "n/a"): [2, 0, 0, 0, 0], ("two", "n/a"): [2, 0, 0, 0, 0]}


def test_two_rules_into_one_cell_add_up(spark):
    spec = ControlSpec("c", "t", "d", [Rule("m", "x", when=F.col("a")), Rule("m", "x", when=F.col("b"))], [("m", "x")])
    df = counts(spark, spec, [(day(1), True, True), (day(1), True, False)], "d date, a boolean, b boolean")
    assert series(df)[("m", "x")][0] == 3


def test_null_or_zero(spark):
    df = counts(spark, cell(null_or_zero(F.col("v"))), [(day(1), None), (day(1), 0), (day(1), 1)], "d date, v int")
    assert series(df)[("m", "x")][0] == 2


def test_text_search_is_case_sensitive(spark):
    rows = [(day(1), "aFREEb"), (day(1), "afreeb"), (day(1), None)]
    assert series(counts(spark, cell(F.col("s").contains("FREE")), rows, "d date, s string"))[("m", "x")][0] == 1


def test_joined_detail_with_a_null_part_does_not_match(spark):
    detail = F.concat("a", F.lit(" - "), "b")
    spec = ControlSpec("c", "t", "d", [Rule("m", detail)], [("m", "p - q")])
    assert series(counts(spark, spec, [(day(1), "p", "q"), (day(1), "p", None)], "d date, a string, b string")) == {
        ("m", "p - q"): [1, 0, 0, 0, 0]
    }


def test_unpivoted_measures(spark):
    detail = F.col("k")
    measures = {"f": "files", "r": "records", "z": "never"}
    spec = ControlSpec(
        "c", "t", "d", unpivot_rules(measures, detail), KeysOf(detail, {label: F.col(c) for c, label in measures.items()})
    )
    rows = [(day(1), "a", 2, 10, None), (day(1), "a", None, 5, None), (day(2), "b", 1, None, None)]
    df = counts(spark, spec, rows, "d date, k string, f bigint, r bigint, z bigint")
    assert series(df) == {
        ("files", "a"): [2, 0, 0, 0, 0],
        ("records", "a"): [15, 0, 0, 0, 0],
        ("files", "b"): [0, 1, 0, 0, 0],
        ("records", "b"): [0, 0, 0, 0, 0],
    }


def test_unpivot_drops_nulls_and_keeps_the_given_labels(spark):
    df = spark.createDataFrame([(1, "p", None), (2, None, None)], "id int, Cat_A string, cat_b string")
    rows = unpivot_nonnull(df, ["id"], {"cat_a": "X", "cat_b": "Y"}, "label", "value").collect()
    assert [tuple(r) for r in rows] == [(1, "X", "p")]


def test_month_turn(spark):
    as_of = dt.date(2024, 3, 3)
    spec = cell(lambda today: same_month(F.col("d"), today))
    rows = [(dt.datetime(2024, 2, 28, 5),), (dt.datetime(2024, 2, 29, 23, 59),), (dt.datetime(2024, 3, 1, 0),), (dt.datetime(2024, 3, 2, 9),)]
    assert series(counts(spark, spec, rows, "d timestamp", as_of)) == {("m", "x"): [0, 0, 0, 1, 1]}


def test_month_ignores_other_years(spark):
    df = spark.createDataFrame([(dt.date(2023, 3, 9),), (dt.date(2024, 3, 31),), (dt.date(2024, 4, 1),), (None,)], "d date")
    assert [r[0] for r in df.select(same_month(F.col("d"), dt.date(2024, 3, 3))).collect()] == [False, True, False, None]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_days_split_at_midnight_utc(spark, kind):
    df = counts(spark, cell(), [(at(2, 23, 30),), (at(3, 0, 30),), (at(3, 0, 0),)], f"d {kind}")
    assert series(df) == {("m", "x"): [0, 1, 2, 0, 0]}


def test_rows_outside_the_window_are_ignored(spark):
    rows = [(at(0),), (at(1, 0, 0),), (at(5, 23, 59),), (at(6, 0, 0),), (None,)]
    assert series(counts(spark, cell(), rows, "d timestamp")) == {("m", "x"): [1, 0, 0, 0, 1]}


def test_unknown_category_is_ignored(spark):
    spec = ControlSpec("c", "t", "d", [Rule("m", F.col("k"))], [("m", "a"), ("m", "b")])
    df = counts(spark, spec, [(day(1), "a"), (day(1), "zzz"), (day(1), None)], "d date, k string")
    assert series(df) == {("m", "a"): [1, 0, 0, 0, 0], ("m", "b"): [0] * 5}


def test_pair_outside_the_grid_is_ignored_even_if_both_parts_are_known(spark):
    spec = ControlSpec("pair", "t", "d", [Rule(F.col("p"), F.col("q"))], [("a", "x"), ("b", "y")])
    for extra in ([], [cell()]):
        rows = [(day(1), "a", "x"), (day(1), "a", "y"), (day(1), "b", "x")]
        tables = {"t": spark.createDataFrame(rows, "d date, p string, q string")}
        df = control_counts(spark, [spec, *extra], AS_OF, tables=tables).where("control = 'pair'")
        assert series(df) == {("a", "x"): [1, 0, 0, 0, 0], ("b", "y"): [0] * 5}


def test_negative_base(spark):
    rows = spark.createDataFrame([("s", 1, -4), ("s", 2, 2)], "k string, t int, v bigint")
    last = period_change(rows, ["k"], "t", "v", "a", "p").orderBy("t").collect()[-1]
    assert (last.a, last.p) == (6, -150.0)


def test_empty_source(spark):
    static = cell()
    derived = ControlSpec("k", "t", "d", [Rule("m", F.col("k"))], KeysOf(F.col("k"), {"m": None}))
    tables = {"t": spark.createDataFrame([], "d date, k string")}
    df = control_counts(spark, [static, derived], AS_OF, tables=tables)
    assert {r.control for r in df.collect()} == {"c"}
    assert series(df) == {("m", "x"): [0] * 5}


def test_two_date_columns_of_one_source(spark):
    first = ControlSpec("a", "t", "d", [Rule("m", "x")], [("m", "x")])
    second = ControlSpec("b", "t", "e", [Rule("m", "x")], [("m", "x")])
    tables = {"t": spark.createDataFrame([(day(1), day(2)), (day(1), day(6))], "d date, e date")}
    df = control_counts(spark, [first, second], AS_OF, tables=tables)
    assert series(df.where("control = 'a'")) == {("m", "x"): [2, 0, 0, 0, 0]}
    assert series(df.where("control = 'b'")) == {("m", "x"): [0, 1, 0, 0, 0]}


def test_column_named_like_a_literal_is_kept_apart(spark):
    """``F.col("k")`` and ``F.lit("k")`` print alike but must not share a grouping key."""
    grid = KeysOf(F.col("k"), {"m": None})
    specs = [
        ControlSpec("a", "t", "d", [Rule("m", F.col("k"))], grid),
        ControlSpec("b", "t", "d", [Rule("m", F.lit("k"))], [("m", "k")]),
        ControlSpec("c", "t", "d", [Rule("m", F.lit("k"))], KeysOf(F.lit("k"), {"m": None})),
    ]
    tables = {"t": spark.createDataFrame([(day(1), "p"), (day(1), "q")], "d date, k string")}
    df = control_counts(spark, specs, AS_OF, tables=tables).where(F.col("control_date") == day(1))
    assert {(r.control, r.metric_detail, r.control_count) for r in df.collect()} == {
        ("a", "p", 1),
        ("a", "q", 1),
        ("b", "k", 2),
        ("c", "k", 2),
    }


def test_operators_on_plain_relations(spark):
    span = DateSpan.before(AS_OF)
    spec = ControlSpec("c", "t", "d", [Rule("m", F.col("k"))], [("m", "a"), ("m", "b")])
    tables = {"t": spark.createDataFrame([(day(1), "a"), (day(1), "a"), (day(2), "b")], "d date, k string")}
    grid = scaffold(spark, [spec], span, tables)
    found = incidents(spark, [spec], span, AS_OF, tables)
    assert grid.columns == ["control", "control_date", "metric", "metric_detail"]
    assert series(zero_filled_counts(grid, found)) == {("m", "a"): [2, 0, 0, 0, 0], ("m", "b"): [0, 1, 0, 0, 0]}
    assert series(sparse_counts(grid, found)) == {("m", "a"): [2], ("m", "b"): [1]}
    assert sorted(grid_counts(grid, found, {"c"}).collect()) == sorted(sparse_counts(grid, found).collect())
    assert metric_grid(spark, [spec], tables).count() == 2


def test_spine_includes_both_ends(spark):
    df = spark.createDataFrame([("a", day(1), day(3)), ("b", day(2), day(2))], "k string, f date, l date")
    rows = date_spine(df, F.col("f"), F.col("l")).select("k", "control_date").collect()
    assert sorted(map(tuple, rows)) == [("a", day(1)), ("a", day(2)), ("a", day(3)), ("b", day(2))]
