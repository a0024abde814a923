"""One control per shape, straight on the test tables."""

from __future__ import annotations

import datetime as dt
from itertools import product

from pyspark.sql import functions as F

from tallygrid import ControlSpec, KeysOf, Rule, same_month
from tallygrid.functions.conditions import null_or_zero

# (as of, days): the days before a fixed date, and all days that the table covers.
WINDOWS = {
    "events": {"recent": (dt.date(2024, 1, 31), 5), "full": (dt.date(2024, 1, 31), 30)},
    "orders": {"recent": (dt.date(1998, 6, 6), 5), "full": (dt.date(2001, 11, 5), 2500)},
    "lineitem": {"recent": (dt.date(1998, 6, 6), 5), "full": (dt.date(2001, 11, 5), 2500)},
}
# Month-to-date controls count only rows of the as-of date's month, so their dates lie inside the orders.
MONTH_TO_DATE = {"recent": (dt.date(1998, 6, 3), 5), "full": (dt.date(2001, 7, 31), 2403)}


def shapes() -> dict[str, ControlSpec]:
    c = F.col
    specs = [
        _cell("cell_error_events", "events", "ts", c("event_type") == "error"),
        _cell("cell_signup_events", "events", "ts", c("event_type") == "signup"),
        _cell("cell_open_lines", "lineitem", "l_shipdate", c("l_linestatus") == "O"),
        _cell(
            "cell_compound_lines",
            "lineitem",
            "l_shipdate",
            (c("l_returnflag") == "A") & (c("l_linestatus") == "F") & (c("l_linenumber") >= 4),
        ),
        _cell("month_to_date_orders", "orders", "o_orderdate", lambda as_of: same_month(c("o_orderdate"), as_of)),
        _category("category_events", "events", "ts", "event_type", ["error", "purchase"]),
        _category("category_distinct_events", "events", "ts", "event_type", ["signup", "view"]),
        _category("category_orders_ts", "orders", "o_orderdate", "o_orderstatus", ["F", "P"]),
        _category(
            "compound_orders",
            "orders",
            "o_orderdate",
            "o_orderpriority",
            ["1-URGENT", "3-MEDIUM", "5-LOW"],
            when=(c("o_orderstatus") != "F") & (c("o_totalprice") > 100000),
        ),
        ControlSpec(
            "two_rules_orders",
            "orders",
            "o_orderdate",
            rules=[
                Rule("finished", "n/a", when=c("o_orderstatus") == "F"),
                Rule(
                    "urgent",
                    "n/a",
                    when=c("o_orderpriority").contains("URGENT")
                    & null_or_zero(F.expr("CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 0 END")),
                ),
            ],
            grid=[("finished", "n/a"), ("urgent", "n/a")],
        ),
        ControlSpec(
            "null_bucket_lines",
            "lineitem",
            "l_shipdate",
            rules=[
                Rule("no discount", "n/a", when=F.expr("nullif(l_discount, 0.0)").isNull()),
                Rule("returned", "n/a", when=c("l_returnflag") == "R"),
            ],
            grid=[("no discount", "n/a"), ("returned", "n/a")],
        ),
        ControlSpec(
            "derived_detail_sum_lines",
            "lineitem",
            "l_shipdate",
            rules=[Rule("flag", c("l_returnflag"), measure=c("l_linenumber"))],
            grid=KeysOf(c("l_returnflag"), {"flag": None}),
        ),
        ControlSpec(
            "derived_detail_cast_events",
            "events",
            "ts",
            rules=[Rule("k", _json_k(), measure=c("user_id"))],
            grid=KeysOf(_json_k(), {"k": None}),
        ),
        ControlSpec(
            "unpivot_measures_lines",
            "lineitem",
            "l_shipdate",
            rules=[
                Rule(label, _flag_and_status(), when=column.isNotNull(), measure=column)
                for label, column in _measures().items()
            ],
            grid=KeysOf(_flag_and_status(), _measures()),
        ),
        ControlSpec(
            "unpivot_categories_lines",
            "lineitem",
            "l_shipdate",
            rules=[Rule("l_returnflag", c("l_returnflag")), Rule("l_linestatus", c("l_linestatus"))],
            grid=[("l_returnflag", "R"), ("l_linestatus", "O")],
        ),
        ControlSpec(
            "sparse_orders",
            "orders",
            "o_orderdate",
            rules=[Rule(c("o_orderstatus"), c("o_orderpriority"))],
            grid=list(product(["F", "O"], ["1-URGENT", "2-HIGH", "5-LOW"])),
            zero_fill=False,
        ),
    ]
    return {spec.control: spec for spec in specs}


def _cell(control, source, date, when):
    return ControlSpec(control, source, date, [Rule("rows", "n/a", when=when)], [("rows", "n/a")])


def _category(control, source, date, column, details, when=None):
    return ControlSpec(control, source, date, [Rule(column, F.col(column), when=when)], [(column, d) for d in details])


def _json_k():
    return F.get_json_object("props", "$.k").cast("int")


def _flag_and_status():
    return F.concat("l_returnflag", F.lit(" - "), "l_linestatus")


def _measures():
    recs = F.col("l_quantity").cast("bigint")
    nothing = F.when(F.col("l_quantity") < 0, recs)
    return {"files": F.col("l_linenumber"), "recs": recs, "diff": recs - 25, "nothing": nothing}
