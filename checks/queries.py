"""Registered queries and their SQL counterparts, keyed alike."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import oracle
from checks.shapes import MONTH_TO_DATE, WINDOWS, shapes
from checks.stand_ins import stand_in_metadata, stand_in_tables
from tallygrid import (
    DateSpan,
    control_counts,
    date_spine,
    incidents,
    metric_grid,
    period_change,
    refresh_times,
    scaffold,
    unified,
    unpivot_nonnull,
)
from tallygrid.functions.conditions import null_or_zero
from tallygrid.functions.dates import same_month
from tallygrid.functions.ratios import safe_divide
from tallygrid.operators.freshness import attach_refresh, refresh_select
from tallygrid.operators.keys import extended_keys, grid_of_keys, key_rows
from tallygrid.plans import catalog
from tallygrid.sources.tables import parquet_tables
from tallygrid.spec import ControlSpec, KeysOf, Rule

Query = Callable[[SparkSession, str], DataFrame]

RECENT = WINDOWS["lineitem"]["recent"]
FULL = WINDOWS["lineitem"]["full"]

STANDARD = {
    "a02q": catalog.completeness,
    "a04q": catalog.rebill,
    "a06m": catalog.leases,
    "a15q": catalog.billing_tasks,
    "a17m": catalog.termination_fees,
    "chv": catalog.charterers,
    "e05w": catalog.activations,
    "f01m": catalog.projects,
    "f12m": catalog.suspense_by_error,
    "fc01q": catalog.commissioning,
    "gx4jx": catalog.usage,
    "ime01w": catalog.suspense_messages,
    "ime02w": catalog.suspense_files,
    "pr1": catalog.provisioning,
    "var1": catalog.variable_leases,
    "x01b": catalog.stopped_vessels,
}
CONTROL_IDS = {
    "a02q": "A02-Q",
    "a04q": "A04-Q",
    "a06m": "A06-M",
    "a15q": "A15-Q",
    "a17m": "A17-M",
    "chv": "CH-V",
    "e05w": "E05-W",
    "f01m": "F01-M",
    "f12m": "F12-M",
    "fc01q": "FC01-Q",
    "gx4jx": "GX4-JX",
    "ime01w": "IME01-W",
    "ime02w": "IME02-W",
    "pr1": "PR-1",
    "var1": "VAR-1",
    "x01b": "X01-B",
}
SHAPE_NAMES = (*oracle.shape_controls(), "month_to_date_orders")


# Counts and change of single controls.


def shape_report(spark: SparkSession, sf_dir: str, name: str, kind: str) -> DataFrame:
    spec = shapes()[name]
    as_of, days = shape_window(name, spec.source, kind)
    return period_change(control_counts(spark, [spec], as_of, days, parquet_tables(spark, sf_dir)))


def shape_window(name: str, source: str, kind: str) -> tuple[dt.date, int]:
    return MONTH_TO_DATE[kind] if name == "month_to_date_orders" else WINDOWS[source][kind]


def shape_sql(name: str, kind: str) -> str:
    if name == "month_to_date_orders":
        as_of, days = MONTH_TO_DATE[kind]
        return oracle.report_sql([oracle.month_control(as_of)], as_of, days)
    control = oracle.shape_controls()[name]
    return oracle.report_sql([control], *WINDOWS[control.source][kind])


def standard_report(spark: SparkSession, sf_dir: str, key: str, window: tuple[dt.date, int]) -> DataFrame:
    return period_change(control_counts(spark, [STANDARD[key]()], *window, stand_in_tables(spark, sf_dir)))


# All controls at once.


def unified_report(spark: SparkSession, sf_dir: str, window: tuple[dt.date, int]) -> DataFrame:
    return unified(
        spark,
        catalog.standard_controls(),
        *window,
        stand_in_tables(spark, sf_dir),
        catalog.REFRESH_SOURCES,
        stand_in_metadata(spark, sf_dir),
    )


def unified_in_ms(spark: SparkSession, sf_dir: str, window: tuple[dt.date, int]) -> DataFrame:
    """The refresh time as epoch milliseconds, which no time zone setting can shift in a comparison."""
    rows = unified_report(spark, sf_dir, window)
    return rows.withColumn("last_refresh_ms", F.unix_millis("last_refresh_time")).drop("last_refresh_time")


def fused_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order and line shape over its whole table: eleven controls in one scan of each table, besides
    one scan for each derived key list and its counts."""
    specs = [s for s in shapes().values() if s.source != "events"]
    return period_change(control_counts(spark, specs, *FULL, parquet_tables(spark, sf_dir)))


def fused_sql() -> str:
    controls = [c for c in oracle.shape_controls().values() if c.source != "events"]
    return oracle.report_sql([*controls, oracle.month_control(FULL[0])], *FULL)


# Parts of the plan.


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event type on every day from its first to its last event."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    seen = events.groupBy("event_type").agg(
        F.min("ts").cast("date").alias("first_day"), F.max("ts").cast("date").alias("last_day")
    )
    return date_spine(seen, F.col("first_day"), F.col("last_day")).drop("first_day", "last_day")


def spine_sql() -> str:
    return """SELECT event_type, CAST(unnest(range(date_trunc('day', min(ts)), max(ts), INTERVAL 1 DAY)) AS DATE)
        AS control_date FROM events GROUP BY event_type"""


def grid_of_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_grid(spark, list(shapes().values()), parquet_tables(spark, sf_dir))


def grid_of_standard_controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_grid(spark, catalog.standard_controls(), stand_in_tables(spark, sf_dir))


def standard_scaffold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaffold(spark, catalog.standard_controls(), DateSpan.before(*RECENT), stand_in_tables(spark, sf_dir))


def scaffold_sql() -> str:
    controls = [c for c in oracle.standard_control_sql(RECENT[0]).values() if c.control != "F12-M"]
    return f"""WITH {oracle.stand_in_ctes([c.source for c in controls])}
        days AS ({oracle.days_sql(*RECENT)}), keys AS ({oracle.grid_sql(controls)})
        SELECT control, control_date, metric, metric_detail FROM days, keys"""


def grid_of_standard_sql() -> str:
    controls = [c for c in oracle.standard_control_sql(RECENT[0]).values() if c.control != "F12-M"]
    return f"WITH {oracle.stand_in_ctes([c.source for c in controls]).rstrip().rstrip(',')} {oracle.grid_sql(controls)}"


def grid_of_shapes_sql() -> str:
    return oracle.grid_sql([*oracle.shape_controls().values(), oracle.month_control(RECENT[0])])


def incident_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights per incident cell and kind of rule, before any grid is involved."""
    specs = [s for s in shapes().values() if s.source == "lineitem"]
    as_of, days = FULL
    rows = incidents(spark, specs, DateSpan.before(as_of, days), as_of, parquet_tables(spark, sf_dir))
    return rows.groupBy("control", "metric", "metric_detail").agg(
        F.sum("hits").alias("incident_rows"), F.sum("weight").alias("total_weight")
    )


def incident_sql() -> str:
    flag_status = "l_returnflag || ' - ' || l_linestatus"
    recs = "CAST(l_quantity AS BIGINT)"
    rules = [
        ("cell_open_lines", "'rows'", "'n/a'", "l_linestatus = 'O'", "1"),
        (
            "cell_compound_lines",
            "'rows'",
            "'n/a'",
            "l_returnflag = 'A' AND l_linestatus = 'F' AND l_linenumber >= 4",
            "1",
        ),
        ("null_bucket_lines", "'no discount'", "'n/a'", "l_discount = 0", "1"),
        ("null_bucket_lines", "'returned'", "'n/a'", "l_returnflag = 'R'", "1"),
        ("derived_detail_sum_lines", "'flag'", "l_returnflag", "true", "l_linenumber"),
        ("unpivot_measures_lines", "'files'", flag_status, "true", "l_linenumber"),
        ("unpivot_measures_lines", "'recs'", flag_status, "true", recs),
        ("unpivot_measures_lines", "'diff'", flag_status, "true", f"{recs} - 25"),
        ("unpivot_categories_lines", "'l_returnflag'", "l_returnflag", "l_returnflag = 'R'", "1"),
        ("unpivot_categories_lines", "'l_linestatus'", "l_linestatus", "l_linestatus = 'O'", "1"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{control}' AS control, {metric} AS metric, {detail} AS metric_detail, count(*) AS incident_rows, "
        f"CAST(sum({weight}) AS BIGINT) AS total_weight FROM lineitem WHERE {when} GROUP BY {detail}"
        if "'" not in detail.replace("' - '", "")
        else f"SELECT '{control}' AS control, {metric} AS metric, {detail} AS metric_detail, count(*) AS incident_rows, "
        f"CAST(sum({weight}) AS BIGINT) AS total_weight FROM lineitem WHERE {when}"
        for control, metric, detail, when, weight in rules
    )


def refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = refresh_times(spark, catalog.REFRESH_SOURCES, stand_in_metadata(spark, sf_dir))
    return times.select("control", F.unix_millis("last_refresh_time").alias("last_refresh_ms"))


def refresh_sql() -> str:
    return f"WITH {oracle.refresh_ctes().rstrip(',')} SELECT control, last_refresh_ms FROM refresh"


# Single operators.


def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of three tables under common names, duplicates kept, columns matched by name not position."""
    read = parquet_tables(spark, sf_dir)
    parts = [
        read("events").select(F.lit("events").alias("source"), F.col("ts").cast("date").alias("day"), F.lit(1).alias("n")),
        read("orders").select(F.lit(1).alias("n"), F.lit("orders").alias("source"), F.col("o_orderdate").cast("date").alias("day")),
        read("lineitem").select(F.col("l_shipdate").cast("date").alias("day"), F.lit(1).alias("n"), F.lit("lineitem").alias("source")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("source", "day").agg(F.sum("n").alias("n"))


def union_all_sql() -> str:
    return """SELECT source, day, count(*) AS n FROM (
        SELECT 'events' AS source, CAST(ts AS DATE) AS day FROM events
        UNION ALL SELECT 'orders', CAST(o_orderdate AS DATE) FROM orders
        UNION ALL SELECT 'lineitem', CAST(l_shipdate AS DATE) FROM lineitem) GROUP BY source, day"""


def two_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily orders by priority beside the lines shipped that day; both sides are reduced before they meet."""
    read = parquet_tables(spark, sf_dir)
    orders = (
        read("orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderstatus").alias("status"))
        .agg(F.count("*").alias("orders"))
    )
    lines = (
        read("lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("day"), F.col("l_linestatus").alias("status"))
        .agg(F.count("*").alias("lines"))
    )
    return orders.join(lines, ["day", "status"], "left").fillna(0, subset=["lines"])


def two_key_join_sql() -> str:
    return """SELECT o.day, o.status, o.orders, coalesce(l.lines, 0) AS lines FROM
        (SELECT CAST(o_orderdate AS DATE) AS day, o_orderstatus AS status, count(*) AS orders
         FROM orders GROUP BY ALL) AS o
        LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS day, l_linestatus AS status, count(*) AS lines
         FROM lineitem GROUP BY ALL) AS l ON o.day = l.day AND o.status = l.status"""


def cross_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every product of every list: all details of a source with each metric that has a value somewhere."""
    spec = shapes()["unpivot_measures_lines"]
    grid = metric_grid(spark, [spec], parquet_tables(spark, sf_dir))
    return grid.groupBy("metric").agg(F.count("*").alias("details"), F.min("metric_detail").alias("first_detail"))


def cross_lists_sql() -> str:
    grid = oracle.shape_controls()["unpivot_measures_lines"].grid
    return f"SELECT metric, count(*) AS details, min(metric_detail) AS first_detail FROM ({grid}) GROUP BY metric"


def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parquet_tables(spark, sf_dir)("lineitem").select("l_suppkey", "l_returnflag").distinct()


def lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order counts per standard control date source, with a refresh time that some of them lack."""
    counts = control_counts(spark, catalog.standard_controls(), *FULL, stand_in_tables(spark, sf_dir))
    per_control = counts.groupBy("control").agg(F.sum("control_count").alias("total"))
    times = refresh_times(spark, catalog.REFRESH_SOURCES, stand_in_metadata(spark, sf_dir))
    return attach_refresh(per_control, times, len(catalog.REFRESH_SOURCES)).select(
        "control", "total", F.unix_millis("last_refresh_time").alias("last_refresh_ms")
    )


def lookup_join_sql() -> str:
    return f"""SELECT control, CAST(sum(control_count) AS BIGINT) AS total, max(last_refresh_ms) AS last_refresh_ms
        FROM ({oracle.unified_sql(*FULL)}) GROUP BY control"""


# Stored relations, without storing them.


def stored_scaffold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts as the second job takes them: on a scaffold that was built before, with its span."""
    as_of, days = FULL
    span = DateSpan.before(as_of, days)
    tables = stand_in_tables(spark, sf_dir)
    specs = catalog.standard_controls()
    grid = scaffold(spark, specs, span, tables)
    return control_counts(spark, specs, as_of, tables=tables, scaffold=grid, span=span)


def stored_scaffold_counts_sql() -> str:
    return f"""SELECT control, control_date, metric, metric_detail, control_count
        FROM ({oracle.unified_sql(*FULL)})"""


def refresh_view_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the stored freshness view: its own SELECT, over the metadata."""
    select = refresh_select(catalog.REFRESH_SOURCES, "{metadata}", braces=True)
    rows = spark.sql(select, metadata=stand_in_metadata(spark, sf_dir))
    return rows.select("control", F.unix_millis("last_refresh_time").alias("last_refresh_ms"))


# Types of sums.


def decimal_measure_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A decimal measure beside a plain count on the same table; shown as doubles, which both engines print alike."""
    discount = F.col("l_discount").cast("decimal(12,2)")
    summed = ControlSpec(
        "decimal_lines",
        "lineitem",
        "l_shipdate",
        [Rule("discount", F.col("l_returnflag"), measure=discount)],
        [("discount", "A"), ("discount", "N"), ("discount", "R")],
    )
    specs = [summed, shapes()["cell_open_lines"]]
    rows = period_change(control_counts(spark, specs, *FULL, parquet_tables(spark, sf_dir)))
    return rows.withColumns({c: F.col(c).cast("double") for c in ("control_count", "daily_absolute_change")})


def decimal_measure_shared_sql() -> str:
    lag = "lag(n) OVER series"
    return f"""WITH days AS ({oracle.days_sql(*FULL)}),
        keys AS (SELECT * FROM (VALUES ('decimal_lines', 'discount', 'A'), ('decimal_lines', 'discount', 'N'),
            ('decimal_lines', 'discount', 'R'), ('cell_open_lines', 'rows', 'n/a')) AS k(control, metric, metric_detail)),
        hits AS (SELECT 'decimal_lines' AS control, CAST(l_shipdate AS DATE) AS control_date, 'discount' AS metric,
                l_returnflag AS metric_detail, CAST(l_discount AS DECIMAL(12, 2)) AS weight FROM lineitem
            UNION ALL SELECT 'cell_open_lines', CAST(l_shipdate AS DATE), 'rows', 'n/a', 1 FROM lineitem
            WHERE l_linestatus = 'O'),
        sums AS (SELECT control, control_date, metric, metric_detail, sum(weight) AS n FROM hits GROUP BY ALL),
        counts AS (SELECT control, control_date, metric, metric_detail, CAST(coalesce(n, 0) AS DECIMAL(38, 6)) AS n
            FROM keys CROSS JOIN days LEFT JOIN sums USING (control, control_date, metric, metric_detail))
        SELECT control, control_date, metric, metric_detail, CAST(n AS DOUBLE) AS control_count,
            CAST(n - {lag} AS DOUBLE) AS daily_absolute_change,
            CAST(n - {lag} AS DOUBLE) / nullif(CAST({lag} AS DOUBLE), 0) * 100 AS daily_percent_change
        FROM counts {oracle.SERIES}"""


# Keys taken from a column of many values.


def supplier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cell for each supplier that any line names, over the last 200 days."""
    spec = ControlSpec(
        "supplier_lines", "lineitem", "l_shipdate", [Rule("lines", F.col("l_suppkey"))], KeysOf(F.col("l_suppkey"), {"lines": None})
    )
    return control_counts(spark, [spec], FULL[0], 200, parquet_tables(spark, sf_dir))


def supplier_counts_sql() -> str:
    control = oracle.Control(
        "supplier_lines",
        "lineitem",
        "l_shipdate",
        "CAST(s.l_suppkey AS VARCHAR) = g.metric_detail",
        detail="CAST(s.l_suppkey AS VARCHAR)",
        metrics={"lines": None},
    )
    rows = oracle.report_sql([control], FULL[0], 200)
    return f"SELECT control, control_date, metric, metric_detail, control_count FROM ({rows})"


def key_registry(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The grid of a control from a registry: keys of the days up to a cut, extended by the days after it."""
    spec = shapes()[name]
    source = parquet_tables(spark, sf_dir)(spec.source)
    cut = FULL[0] - dt.timedelta(days=FULL[1] // 2)
    before = key_rows(source.where(F.col(spec.date).cast("date") <= F.lit(cut)), spec)
    return grid_of_keys(extended_keys(before, source, spec, cut), spec)


def key_registry_sql(name: str) -> str:
    """The distinct keys of the whole history, with the metrics that have a value anywhere."""
    control = oracle.shape_controls()[name]
    return f"SELECT DISTINCT control, metric, metric_detail FROM ({oracle.grid_sql([control])})"


def unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two nullable columns of every line to rows; NULLs give no row."""
    lines = parquet_tables(spark, sf_dir)("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.expr("nullif(l_returnflag, 'N')").alias("flag"),
        F.expr("nullif(l_linestatus, 'O')").alias("status"),
    )
    return unpivot_nonnull(lines, ["l_orderkey", "l_linenumber"], {"flag": "Flag", "status": "STATUS"}, "label", "value")


def unpivot_sql() -> str:
    return """SELECT l_orderkey, l_linenumber, 'Flag' AS label, l_returnflag AS value
        FROM lineitem WHERE l_returnflag <> 'N'
        UNION ALL SELECT l_orderkey, l_linenumber, 'STATUS', l_linestatus FROM lineitem WHERE l_linestatus <> 'O'"""


def unpivot_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = KeysOf(F.lit("all"), {"tax": F.col("l_tax"), "none": F.expr("CASE WHEN l_tax < -1 THEN l_tax END")})
    from tallygrid.operators.grid import source_keys

    return source_keys(parquet_tables(spark, sf_dir)("lineitem"), "labels", spec).select("metric")


def unpivot_labels_sql() -> str:
    return """SELECT 'tax' AS metric FROM lineitem HAVING count(l_tax) > 0
        UNION ALL SELECT 'none' FROM lineitem HAVING count(CASE WHEN l_tax < -1 THEN l_tax END) > 0"""


def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = parquet_tables(spark, sf_dir)("orders")
    day = F.col("o_orderdate").cast("date")
    key = F.col("o_custkey")
    status = F.expr("nullif(o_orderstatus, 'P')")
    return orders.select(
        "o_orderkey",
        F.date_sub(day, 5).alias("five_days_before"),
        F.trunc(day, "MONTH").alias("month_start"),
        same_month(day, dt.date(1998, 6, 3)).alias("in_june_1998"),
        F.concat(status, F.lit(" - "), "o_orderpriority").alias("joined_text"),
        F.when(F.col("o_orderpriority").contains("URGENT"), "urgent").otherwise("normal").alias("urgency"),
        F.coalesce(key.cast("string"), F.lit("none")).alias("customer_text"),
        safe_divide(key - 100, F.expr("nullif(o_custkey, 7)")).alias("ratio"),
        null_or_zero(F.expr("nullif(o_custkey, 3)")).alias("null_or_zero"),
        (status != "F").alias("status_differs"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("is_high"),
        F.unix_millis(F.timestamp_millis(key * 1000)).alias("millis"),
    )


def scalar_functions_sql() -> str:
    return """SELECT o_orderkey,
        CAST(CAST(o_orderdate AS DATE) - INTERVAL 5 DAY AS DATE) AS five_days_before,
        CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
        strftime(o_orderdate, '%Y-%m') = '1998-06' AS in_june_1998,
        nullif(o_orderstatus, 'P') || ' - ' || o_orderpriority AS joined_text,
        CASE WHEN o_orderpriority LIKE '%URGENT%' THEN 'urgent' ELSE 'normal' END AS urgency,
        coalesce(CAST(o_custkey AS VARCHAR), 'none') AS customer_text,
        CAST(o_custkey - 100 AS DOUBLE) / nullif(nullif(o_custkey, 7), 0) AS ratio,
        (nullif(o_custkey, 3) IS NULL OR nullif(o_custkey, 3) = 0) AS null_or_zero,
        nullif(o_orderstatus, 'P') <> 'F' AS status_differs,
        o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_high,
        o_custkey * 1000 AS millis
        FROM orders"""


def change_of_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-over-day change of the events of each type, without a grid."""
    events = parquet_tables(spark, sf_dir)("events")
    daily = events.groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
    return period_change(daily, ["event_type"], "day", "n", "absolute", "percent")


def change_of_values_sql() -> str:
    return """SELECT *, n - lag(n) OVER w AS absolute, (n - lag(n) OVER w) / nullif(lag(n) OVER w, 0) * 100 AS percent
        FROM (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL)
        WINDOW w AS (PARTITION BY event_type ORDER BY day)"""


def registry() -> dict[str, tuple[Query, str]]:
    entries: dict[str, tuple[Query, str]] = {
        "unified": (partial(unified_in_ms, window=RECENT), oracle.unified_sql(*RECENT)),
        "unified_full": (partial(unified_in_ms, window=FULL), oracle.unified_sql(*FULL)),
        "fused_shapes_full": (fused_report, fused_sql()),
        "date_spine": (spine, spine_sql()),
        "metric_grid": (grid_of_standard_controls, grid_of_standard_sql()),
        "metric_grid_shapes": (grid_of_shapes, grid_of_shapes_sql()),
        "scaffold": (standard_scaffold, scaffold_sql()),
        "incidents_full": (incident_rows, incident_sql()),
        "refresh_times": (refresh, refresh_sql()),
        "period_change_events": (change_of_values, change_of_values_sql()),
        "union_by_name": (union_all, union_all_sql()),
        "two_key_join": (two_key_join, two_key_join_sql()),
        "cross_lists": (cross_lists, cross_lists_sql()),
        "distinct_keys": (distinct_keys, "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem"),
        "lookup_join": (lookup_join, lookup_join_sql()),
        "stored_scaffold_counts_full": (stored_scaffold_counts, stored_scaffold_counts_sql()),
        "refresh_view_rows": (refresh_view_rows, refresh_sql()),
        "decimal_measure_shared_full": (decimal_measure_shared, decimal_measure_shared_sql()),
        "supplier_keys_counts": (supplier_counts, supplier_counts_sql()),
        "key_registry_sums": (partial(key_registry, name="derived_detail_sum_lines"), key_registry_sql("derived_detail_sum_lines")),
        "key_registry_unpivot": (partial(key_registry, name="unpivot_measures_lines"), key_registry_sql("unpivot_measures_lines")),
        "unpivot_nonnull": (unpivot, unpivot_sql()),
        "unpivot_labels": (unpivot_labels, unpivot_labels_sql()),
        "scalar_functions": (scalar_functions, scalar_functions_sql()),
    }
    for key, control in CONTROL_IDS.items():
        windows = MONTH_TO_DATE if key == "a15q" else {"recent": RECENT, "full": FULL}
        for suffix, window in (("", windows["recent"]), ("_full", windows["full"])):
            entries[f"control_{key}{suffix}"] = (
                partial(standard_report, key=key, window=window),
                oracle.standard_report_sql([control], *window),
            )
    for name in SHAPE_NAMES:
        for suffix, kind in (("", "recent"), ("_full", "full")):
            entries[f"{name}{suffix}"] = (partial(shape_report, name=name, kind=kind), shape_sql(name, kind))
    return entries
