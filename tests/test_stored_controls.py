"""Controls kept as rows: round trip of the standard ones, and every fault named before a run."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks.queries import FULL
from checks.stand_ins import stand_in_tables
from tallygrid import control_counts
from tallygrid.plans.catalog import standard_controls, suspense_by_error
from tallygrid.plans.stored_controls import CONTROLS, InvalidControls, control_rows, load_controls, store_controls

TINY = "/root/testdata/sf0.001"
#: The text of the one standard condition that depends on the day of the run.
THIS_MONTH = {("A15-Q", 0): "trunc(CAST(billing_task_completed_on AS DATE), 'MONTH') = trunc(:as_of, 'MONTH')"}


def test_standard_controls_round_trip(spark):
    tables = stand_in_tables(spark, TINY)
    specs = [*standard_controls(), suspense_by_error()]
    rows = control_rows(spark, specs, tables, THIS_MONTH)
    loaded = load_controls(spark, rows, tables)
    assert [s.control for s in loaded] == sorted(s.control for s in specs)
    again = control_rows(spark, loaded, tables, THIS_MONTH)
    assert sorted(again.collect(), key=str) == sorted(rows.collect(), key=str)
    as_of, days = FULL
    expected = sorted(map(tuple, control_counts(spark, specs, as_of, days, tables).where("control_count <> 0").collect()), key=str)
    found = sorted(map(tuple, control_counts(spark, loaded, as_of, days, tables).where("control_count <> 0").collect()), key=str)
    assert found == expected
    assert len({r[0] for r in found}) > 10


SOURCE = "at timestamp, kind string, n bigint, price decimal(10,2), tags array<string>, ok boolean"


def rule(metric="m", metric_of=None, detail="d", detail_of=None, condition=None, measure=None):
    return (metric, metric_of, detail, detail_of, condition, measure)


def control(name="C", source="t", date="at", rules=None, cells=(("m", "d"),), keys=None):
    return (name, source, date, True, [rule()] if rules is None else rules, None if cells is None else list(cells), keys)


@pytest.mark.parametrize(
    ("row", "field", "reason"),
    [
        (control(source="missing"), "source", "missing"),
        (control(date="nothing"), "date", "nothing"),
        (control(date="kind"), "date", "string, not a date or timestamp"),
        (control(date=None), "date", "missing"),
        (control(date="to_date(kind)"), "date", "not a column"),
        (control(rules=[]), "rules", "there is none"),
        (control(rules=[rule(condition="kindd = 'x'")]), "rules[0].condition", "kindd"),
        (control(rules=[rule(condition="n + 1")]), "rules[0].condition", "bigint, not true or false"),
        (control(rules=[rule(condition="ok AND (")]), "rules[0].condition", "PARSE"),
        (control(rules=[rule(), rule(measure="kind")]), "rules[1].measure", "string, not a number"),
        (control(rules=[rule(detail=None, detail_of="tags")]), "rules[0].metric_detail_of", "array<string>"),
        (control(rules=[rule(metric=None)]), "rules[0].metric", "literal or as an expression"),
        (control(rules=[rule(metric_of="kind")]), "rules[0].metric", "literal or as an expression"),
        (control(cells=None), "cells", "either cells or keys"),
        (control(cells=None, keys=("nope", [("m", None)])), "keys.metric_detail", "nope"),
        (control(cells=None, keys=("kind", [("m", "nope")])), "keys.metrics[0].value", "nope"),
        (control(cells=None, keys=("kind", [])), "keys.metrics", "there is none"),
        (control(cells=(("other", "d"),)), "control", "no expected cell fits"),
        (control(name=None), "control", "has no id"),
    ],
)
def test_faults_are_named_before_a_run(spark, row, field, reason):
    tables = {"t": spark.createDataFrame([], SOURCE)}
    sound = control(name="A")
    with pytest.raises(InvalidControls) as raised:
        load_controls(spark, spark.createDataFrame([row, sound], CONTROLS), tables)
    assert [f.control for f in raised.value.faults] == [row[0] or "(no id)"]
    assert raised.value.faults[0].field == field
    assert reason in raised.value.faults[0].reason


def test_all_faults_are_told_at_once(spark):
    tables = {"t": spark.createDataFrame([], SOURCE)}
    rows = [control(name="B", date="kind", rules=[rule(condition="n", measure="kind")]), control(name="A", source="x"), control(name="D"), control(name="D")]
    with pytest.raises(InvalidControls) as raised:
        load_controls(spark, spark.createDataFrame(rows, CONTROLS), tables)
    assert [(f.control, f.field) for f in raised.value.faults] == [
        ("A", "source"),
        ("B", "date"),
        ("B", "rules[0].condition"),
        ("B", "rules[0].measure"),
        ("D", "control"),
    ]


def test_stored_controls_count(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS kept")
    try:
        source = spark.sql("SELECT TIMESTAMP'2024-06-09 12:00:00' AS at, 'a' AS kind, 3L AS n, 1.50 AS price, array('x') AS tags, true AS ok")
        rows = [
            control(name="A", rules=[rule("m", None, None, "kind", "ok AND month(at) = month(:as_of)", "n * 2")], cells=(("m", "a"), ("m", "b"))),
            control(name="B", rules=[rule("m", None, None, "kind")], cells=None, keys=("kind", [("m", "price")])),
        ]
        specs = store_controls(spark, spark.createDataFrame(rows, CONTROLS), "kept.controls", {"t": source})
        import datetime as dt

        counts = control_counts(spark, specs, dt.date(2024, 6, 11), 2, {"t": source}).where(F.col("control_count") > 0)
        assert {(r.control, r.metric_detail, r.control_count) for r in counts.collect()} == {("A", "a", 6), ("B", "a", 1)}
        quiet = control_counts(spark, specs, dt.date(2024, 7, 1), 30, {"t": source}).where(F.col("control_count") > 0)
        assert {r.control for r in quiet.collect()} == {"B"}
        broken = spark.createDataFrame([control(date="kind")], CONTROLS)
        with pytest.raises(InvalidControls):
            store_controls(spark, broken, "kept.controls", {"t": source})
        assert len(load_controls(spark, spark.table("kept.controls"), {"t": source})) == 2
    finally:
        spark.sql("DROP DATABASE kept CASCADE")
