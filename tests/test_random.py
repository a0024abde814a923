"""Random rows: the library against the obvious join per control, and properties of the result."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks.direct import direct_counts
from tallygrid import ControlSpec, DateSpan, KeysOf, Rule, control_counts, incidents, period_change, unpivot_rules
from tests.helpers import AS_OF

SCHEMA = "d timestamp, e date, k string, p string, n int, v bigint, w bigint, flag boolean"


def rows(seed: int, size: int) -> list[tuple]:
    rng = random.Random(seed)

    def maybe(value):
        return None if rng.random() < 0.15 else value

    def one():
        moment = dt.datetime.combine(AS_OF, dt.time()) - dt.timedelta(minutes=rng.randint(-1500, 10000))
        return (
            maybe(moment),
            maybe(moment.date()),
            # One key and one portal hold most rows.
            maybe(rng.choice("aaaaabcd")),
            maybe(rng.choice("xxxyz")),
            maybe(rng.randint(1, 4)),
            maybe(rng.randint(-3, 3)),
            maybe(rng.randint(0, 9)),
            maybe(rng.random() < 0.5),
        )

    return [one() for _ in range(size)]


def specs() -> list[ControlSpec]:
    c = F.col
    pair = F.concat("k", F.lit(" - "), "p")
    measures = {"v": "V", "w": "W"}
    return [
        ControlSpec("cell", "t", "d", [Rule("m", "x", when=c("flag"))], [("m", "x")]),
        ControlSpec("all", "t", "e", [Rule("m", "x")], [("m", "x")]),
        ControlSpec("listed", "t", "d", [Rule("m", c("k"), when=c("n") != 2)], [("m", "a"), ("m", "d"), ("m", "none")]),
        ControlSpec(
            "two rules", "t", "d", [Rule("r", "x", when=c("flag")), Rule("s", "x", when=c("v").isNull())], [("r", "x"), ("s", "x")]
        ),
        ControlSpec("derived", "t", "e", [Rule("m", c("n"), measure=c("v"))], KeysOf(c("n"), {"m": None})),
        ControlSpec("measures", "t", "d", unpivot_rules(measures, pair), KeysOf(pair, {"V": c("v"), "W": c("w")})),
        ControlSpec("columns", "t", "d", [Rule("k", c("k")), Rule("p", c("p"))], [("k", "a"), ("p", "z"), ("p", "a")]),
        ControlSpec(
            "sparse", "t", "d", [Rule(c("k"), c("p"))], [(k, p) for k in "abc" for p in "xy"], zero_fill=False
        ),
        ControlSpec(
            "wide", "t", "d", [Rule(c("k"), c("p"))], [(k, p) for k in "abcdef" for p in "xyzuv"], zero_fill=False
        ),
    ]


@pytest.mark.parametrize(("seed", "size"), [(1, 0), (2, 3), (3, 40), (4, 400), (5, 1500)])
def test_same_as_one_join_per_control(spark, seed, size):
    tables = {"t": spark.createDataFrame(rows(seed, size), SCHEMA)}
    fused = control_counts(spark, specs(), AS_OF, tables=tables)
    direct = direct_counts(spark, specs(), AS_OF, 5, tables.__getitem__).select(*fused.columns)
    assert Counter(fused.collect()) == Counter(direct.collect())


@pytest.mark.parametrize("index", range(9))
def test_each_control_alone_same_as_among_others(spark, index):
    tables = {"t": spark.createDataFrame(rows(7, 300), SCHEMA)}
    spec = specs()[index]
    alone = control_counts(spark, [spec], AS_OF, tables=tables)
    together = control_counts(spark, specs(), AS_OF, tables=tables).where(F.col("control") == spec.control)
    assert sorted(alone.collect(), key=str) == sorted(together.collect(), key=str)


def test_properties(spark):
    data = rows(8, 600)
    base = spark.createDataFrame(data, SCHEMA)
    counted = control_counts(spark, specs(), AS_OF, tables={"t": base}).cache()

    # A full grid for every zero-filled control.
    cells = counted.select("control", "metric", "metric_detail").distinct()
    dense = counted.where("control NOT IN ('sparse', 'wide')")
    assert dense.count() == 5 * cells.where("control NOT IN ('sparse', 'wide')").count()

    # Order, partitioning and rows outside the window do not matter.
    outside = [(dt.datetime(2020, 1, 1), dt.date(2020, 1, 1), "a", "x", 1, 1, 1, True)] * 50
    moved = spark.createDataFrame(list(reversed(data)) + outside, SCHEMA).repartition(5)
    again = control_counts(spark, specs(), AS_OF, tables={"t": moved})
    assert Counter(again.collect()) == Counter(counted.collect())

    # Changes of a series add up to last minus first.
    changes = period_change(dense).groupBy("control", "metric", "metric_detail").agg(
        F.sum("daily_absolute_change").alias("moved"),
        (F.max_by("control_count", "control_date") - F.min_by("control_count", "control_date")).alias("distance"),
    )
    assert changes.where("moved <> distance").count() == 0

    # The counts add up to the qualifying rows.
    first = DateSpan.before(AS_OF).first
    qualifying = [r for r in data if r[0] and first <= r[0].date() < AS_OF and r[7]]
    assert counted.where("control = 'cell'").agg(F.sum("control_count")).first()[0] == len(qualifying)
    counted.unpersist()


def test_one_scan_per_key_of_a_source(spark):
    tables = {"t": spark.createDataFrame(rows(9, 10), SCHEMA)}
    literal = [s for s in specs() if s.control in ("cell", "listed", "two rules", "columns", "sparse")]
    text = incidents(spark, literal, DateSpan.before(AS_OF), AS_OF, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LogicalRDD") == 1
