"""The same results in plain SQL for DuckDB, worked out per cell from the raw rows.

Every expected cell asks its source how many rows belong to it. That is the definition of the result
and shares nothing with the way the Spark side gets there.
"""

from __future__ import annotations

import datetime as dt
from itertools import product

from checks.stand_ins import METADATA, STAND_INS

CHANGE = """
    control_count - lag(control_count) OVER series AS daily_absolute_change,
    (control_count - lag(control_count) OVER series) / nullif(lag(control_count) OVER series, 0) * 100
        AS daily_percent_change"""
SERIES = "WINDOW series AS (PARTITION BY control, metric, metric_detail ORDER BY control_date)"


def quoted(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def days_sql(as_of: dt.date, days: int) -> str:
    first = as_of - dt.timedelta(days=days)
    return (
        f"SELECT CAST(d AS DATE) AS control_date "
        f"FROM range(TIMESTAMP '{first}', TIMESTAMP '{as_of}', INTERVAL 1 DAY) AS r(d)"
    )


def cells_sql(control: str, cells: list[tuple[str, str]]) -> str:
    rows = ", ".join(f"({quoted(control)}, {quoted(m)}, {quoted(d)})" for m, d in cells)
    return f"SELECT * FROM (VALUES {rows}) AS c(control, metric, metric_detail)"


def keys_sql(control: str, source: str, detail: str, metrics: dict[str, str | None]) -> str:
    """Distinct details of the source, once for each metric that has a value anywhere."""
    parts = [
        f"SELECT DISTINCT {quoted(control)} AS control, {quoted(metric)} AS metric, {detail} AS metric_detail "
        f"FROM {source} AS s"
        + ("" if value is None else f" WHERE EXISTS (SELECT 1 FROM {source} AS s WHERE {value} IS NOT NULL)")
        for metric, value in metrics.items()
    ]
    return " UNION ALL ".join(parts)


def counts_sql(control: str, source: str, day: str, belongs: str, measure: str | None = None) -> str:
    value = "count(*)" if measure is None else f"CAST(coalesce(sum({measure}), 0) AS BIGINT)"
    return f"""SELECT g.control, g.control_date, g.metric, g.metric_detail,
        (SELECT {value} FROM {source} AS s
         WHERE CAST(s.{day} AS DATE) = g.control_date AND ({belongs})) AS control_count
    FROM grid AS g WHERE g.control = {quoted(control)}"""


class Control:
    """SQL pieces of one control: expected cells, and which rows of the source belong to a cell ``g``."""

    def __init__(self, control, source, day, belongs, cells=None, detail=None, metrics=None, measure=None, sparse=False):
        self.control = control
        self.source = source
        self.grid = cells_sql(control, cells) if cells else keys_sql(control, source, detail, metrics)
        self.counts = counts_sql(control, source, day, belongs, measure)
        if sparse:
            self.counts = f"SELECT * FROM ({self.counts}) WHERE control_count > 0"


def grid_sql(controls: list[Control]) -> str:
    return " UNION ALL ".join(c.grid for c in controls)


def report_sql(controls: list[Control], as_of: dt.date, days: int, ctes: str = "", extra: str = "", joins: str = "") -> str:
    counts = " UNION ALL ".join(c.counts for c in controls)
    return f"""WITH {ctes}
        days AS ({days_sql(as_of, days)}),
        keys AS ({grid_sql(controls)}),
        grid AS (SELECT control, control_date, metric, metric_detail FROM keys, days),
        counts AS ({counts}),
        changes AS (SELECT *, {CHANGE} FROM counts {SERIES})
    SELECT changes.*{extra} FROM changes {joins}"""


# Controls on the test tables.


def shape_controls() -> dict[str, Control]:
    same_detail = "s.{} = g.metric_detail".format
    flag_status = "s.l_returnflag || ' - ' || s.l_linestatus"
    recs = "CAST(s.l_quantity AS BIGINT)"
    nothing = f"CASE WHEN s.l_quantity < 0 THEN {recs} END"
    json_k = "CAST(CAST(json_extract_string(s.props, '$.k') AS INTEGER) AS VARCHAR)"
    one = [("rows", "n/a")]
    controls = [
        Control("cell_error_events", "events", "ts", "s.event_type = 'error'", one),
        Control("cell_signup_events", "events", "ts", "s.event_type = 'signup'", one),
        Control("cell_open_lines", "lineitem", "l_shipdate", "s.l_linestatus = 'O'", one),
        Control(
            "cell_compound_lines",
            "lineitem",
            "l_shipdate",
            "s.l_returnflag = 'A' AND s.l_linestatus = 'F' AND s.l_linenumber >= 4",
            one,
        ),
        Control(
            "category_events", "events", "ts", same_detail("event_type"), [("event_type", "error"), ("event_type", "purchase")]
        ),
        Control(
            "category_distinct_events",
            "events",
            "ts",
            same_detail("event_type"),
            [("event_type", "signup"), ("event_type", "view")],
        ),
        Control(
            "category_orders_ts",
            "orders",
            "o_orderdate",
            same_detail("o_orderstatus"),
            [("o_orderstatus", "F"), ("o_orderstatus", "P")],
        ),
        Control(
            "compound_orders",
            "orders",
            "o_orderdate",
            same_detail("o_orderpriority") + " AND s.o_orderstatus <> 'F' AND s.o_totalprice > 100000",
            [("o_orderpriority", p) for p in ("1-URGENT", "3-MEDIUM", "5-LOW")],
        ),
        Control(
            "two_rules_orders",
            "orders",
            "o_orderdate",
            "CASE g.metric WHEN 'finished' THEN s.o_orderstatus = 'F' ELSE s.o_orderpriority LIKE '%URGENT%' "
            "AND s.o_orderstatus <> 'O' END",
            [("finished", "n/a"), ("urgent", "n/a")],
        ),
        Control(
            "null_bucket_lines",
            "lineitem",
            "l_shipdate",
            "CASE g.metric WHEN 'returned' THEN s.l_returnflag = 'R' ELSE s.l_discount = 0 END",
            [("no discount", "n/a"), ("returned", "n/a")],
        ),
        Control(
            "derived_detail_sum_lines",
            "lineitem",
            "l_shipdate",
            same_detail("l_returnflag"),
            detail="l_returnflag",
            metrics={"flag": None},
            measure="s.l_linenumber",
        ),
        Control(
            "derived_detail_cast_events",
            "events",
            "ts",
            f"{json_k} = g.metric_detail",
            detail=json_k,
            metrics={"k": None},
            measure="s.user_id",
        ),
        Control(
            "unpivot_measures_lines",
            "lineitem",
            "l_shipdate",
            f"{flag_status} = g.metric_detail",
            detail=flag_status,
            metrics={"files": "s.l_linenumber", "recs": recs, "diff": f"{recs} - 25", "nothing": nothing},
            measure=f"CASE g.metric WHEN 'files' THEN s.l_linenumber WHEN 'recs' THEN {recs} WHEN 'diff' THEN {recs} - 25 END",
        ),
        Control(
            "unpivot_categories_lines",
            "lineitem",
            "l_shipdate",
            "g.metric_detail = CASE g.metric WHEN 'l_returnflag' THEN s.l_returnflag ELSE s.l_linestatus END",
            [("l_returnflag", "R"), ("l_linestatus", "O")],
        ),
        Control(
            "sparse_orders",
            "orders",
            "o_orderdate",
            "s.o_orderstatus = g.metric AND s.o_orderpriority = g.metric_detail",
            list(product(["F", "O"], ["1-URGENT", "2-HIGH", "5-LOW"])),
            sparse=True,
        ),
    ]
    return {c.control: c for c in controls}


def month_control(as_of: dt.date) -> Control:
    month = f"date_trunc('month', s.o_orderdate) = date_trunc('month', DATE '{as_of}')"
    return Control("month_to_date_orders", "orders", "o_orderdate", month, [("rows", "n/a")])


# The standard controls on their stand-in sources. Sources become CTEs named by position.

STAND_IN_NAMES = {name: f"source_{i}" for i, name in enumerate(STAND_INS)}


def stand_in_ctes(sources: list[str]) -> str:
    """CTEs of the named stand-in sources, with a trailing comma."""
    return "".join(
        f"{cte} AS (SELECT {', '.join(STAND_INS[name][1])} FROM {STAND_INS[name][0]}),\n"
        for name, cte in STAND_IN_NAMES.items()
        if cte in sources
    )


def standard_control_sql(as_of: dt.date) -> dict[str, Control]:
    def source(ending: str) -> str:
        (name,) = [n for n in STAND_INS if n.endswith(ending)]
        return STAND_IN_NAMES[name]

    timing = "Timing issue - active billing billing task - check in the next control run"
    stop_1 = "Review - active temp stop vessel, why billed with original charges"
    stop_2 = "Review - why billed with suspended charges although they are reactivated"
    # Fixed values.
    provisioning = [
        "Bill no service",
        "Duplicates in billing",
        "Rate plan mismatch",
        "Rate plan mismatch - NULL in billing",
        "Rate plan mismatch - NULL in provisioning",
        "Rate plan mismatch - Possible timing issue",
        "Rate plan mismatch - Retail service",
        "Service no bill",
        "Service no bill - Possible timing issue",
        "Service no bill - Retail service",
        "Status mismatch",
        "Status mismatch - Possible timing issue",
        "Status mismatch - Retail service",
    ]
    statuses = "'No billing available - needs review', 'Old billing - needs review'"
    measures = ("files_collected", "ime_totrecsrecvd", "ime_v_sv_difference")
    portal = "s.traffic_type || ' - ' || s.ime_acquisitionportal"
    controls = [
        Control(
            "A02-Q",
            source("snb_control_monthly_data"),
            "current_commissioning_confirmed_date",
            "s.category1 = g.metric_detail",
            [("Category 1", "Review for charges"), ("Category 1", timing)],
        ),
        Control(
            "A04-Q",
            source("alteryx_output"),
            "crc_created_on",
            "s.sap_exception = g.metric_detail",
            [
                ("SAP Exception", "Exception, SAP data found but totals mismatch"),
                ("SAP Exception", "SAP data not found"),
            ],
        ),
        Control(
            "A06-M",
            source("vw_control_monthly"),
            "contract_start_date",
            "NOT s.lease_cancelled AND NOT s.wholesale_part_of_retail_lease AND CASE g.metric "
            "WHEN 'Not Billed as Planned' THEN NOT s.billed_as_expected "
            "ELSE contains(s.lease_contract_number, 'FREE') AND coalesce(s.contract_value, 0) = 0 END",
            [("Not Billed as Planned", "n/a"), ("Unpriced Lease", "n/a")],
        ),
        Control(
            "A15-Q",
            source("a15q_extract"),
            "billing_task_completed_on",
            f"strftime(s.billing_task_completed_on, '%Y-%m') = '{as_of:%Y-%m}'",
            [("Billing task completed on", "Current month")],
        ),
        Control(
            "A17-M",
            source("fees_calculated"),
            "billing_task_completed_on",
            "CASE g.metric WHEN 'Null SAP Net Value' THEN s.sap_net_value IS NULL ELSE s.is_vessel_ooc = g.metric END",
            [("Null SAP Net Value", "n/a"), ("Vessel is inside committment period", "n/a")],
        ),
        Control(
            "CH-V",
            source("chv_extract"),
            "charterer_start_date",
            "s.check_for_charterer_plan_billied = g.metric_detail",
            [("check_for_Charterer_plan_billied", "Review for charges - Not found in billing")],
        ),
        Control(
            "E05-W",
            source("control_e05w.output_data"),
            "activation_date",
            "s.review_required = 'Review'",
            [("Review Required", "Review")],
        ),
        Control(
            "F01-M",
            source("pulse_projects_reconciliation.control_monthly_data"),
            "project_implementation_confirmed_date",
            f"s.project_type = g.metric_detail AND s.billing_status IN ({statuses}) "
            "AND s.project_status <> 'Stopped' AND s.billed_arrears = 'Not billed in arrears'",
            [("Tasks Remaining", t) for t in ("Contract change", "New installation", "Upgrade installation")],
        ),
        Control(
            "F12-M",
            source("tableau_summary"),
            "chargestartdate",
            "CAST(s.errormessageid AS VARCHAR) = g.metric_detail",
            detail="CAST(s.errormessageid AS VARCHAR)",
            metrics={"ErrorMessageID": None},
            measure="s.countoferrors",
        ),
        Control(
            "FC01-Q",
            source("fc01q_extract"),
            "commissioning_confirm_date",
            "s.pulse_vs_nuda_category_1 = g.metric_detail",
            [("pulse_vs_nuda_category_1", "Review needed - no charges matching with Vessel ID")],
        ),
        Control(
            "GX4-JX",
            source("output_control_outcomes"),
            "control_date",
            "s.control_group = 'Usage' AND s.control_name = g.metric AND s.exception_type = 'Difference greater than 2.5%'",
            [("DAL vs BTP Usage by SSPC", "Difference Greater than 2.5%")],
        ),
        Control(
            "IME01-W",
            source("IME_Tableau_Summary"),
            "chargestartdate",
            "s.errormessageid = g.metric_detail",
            detail="s.errormessageid",
            metrics={"ErrorMessageID": None},
            measure="s.countoferrors",
        ),
        Control(
            "IME02-W",
            source("IME_SV_Summary"),
            "ime_ime_file_date",
            f"{portal} = g.metric_detail",
            detail=portal,
            metrics={m: f"s.{m}" for m in measures},
            measure=f"CASE g.metric {' '.join(f'WHEN {quoted(m)} THEN s.{m}' for m in measures)} END",
        ),
        Control(
            "PR-1",
            source("controls_history"),
            "control_timestamp",
            "s.product_group = g.metric AND s.exception_type = g.metric_detail",
            list(product(["BGAN", "Classic Aero", "Fleet Mail", "GX", "Inm-C"], provisioning)),
            sparse=True,
        ),
        Control(
            "VAR-1",
            source("control_output_for_review2"),
            "order_date",
            "g.metric_detail = CASE g.metric WHEN 'category_1' THEN s.category_1 ELSE s.billed_in_sv_category END",
            [("category_1", "Review needed?"), ("Billed_in_SV_category", "HP - billed in last 3 months")],
        ),
        Control(
            "X01-B",
            source("temp_stop_vessels"),
            "stopped_confirmed_date",
            "s.category1 = g.metric_detail",
            [("Category 1", stop_1), ("Category 1", stop_2)],
        ),
    ]
    return {c.control: c for c in controls}


def standard_report_sql(names: list[str], as_of: dt.date, days: int) -> str:
    controls = [c for name, c in standard_control_sql(as_of).items() if name in names]
    return report_sql(controls, as_of, days, stand_in_ctes([c.source for c in controls]))


# Freshness.

REFRESH = [
    ("A02-Q", "pulse", "vw_project_tasks"),
    ("A04-Q", "control_a04q_rebill", "alteryx_output"),
    ("A06-M", "control_a06m_leases", "dim_lease_history"),
    ("A15-Q", "pulse", "vw_project_tasks"),
    ("A17-M", "pulse", "vw_project_tasks"),
    ("CH-V", "billing_src", "derived_attribute_array"),
    ("E05-W", "control_e05w", "output_data"),
    ("F01-M", "pulse", "vw_project_tasks"),
    ("F12-M", "control_f12m_btp_suspense", "sim_tracker"),
    ("FC01-Q", "pulse_src", "vessel"),
    ("GX4-JX", "control_gx4", "output_control_outcomes"),
    ("IME01-W", "ime_suspense", "EPS_Suspense"),
    ("IME02-W", "control_ime_sv", "ime_summary"),
    ("PR-1", "control_pr1_provisioning", "controls_history"),
    ("VAR-1", "control_var_01_leases", "output_var_leases_alteryx_data"),
    ("X01-B", "pulse_src", "vessel"),
]


def refresh_ctes() -> str:
    tables = " UNION ALL ".join(
        f"SELECT {quoted(d)} AS dataset_id, {quoted(t)} AS table_id, "
        f"CAST(epoch_us(max({column})) // 1000 AS BIGINT) AS last_modified_time FROM {base}"
        for d, t, base, column in METADATA
    )
    wanted = ", ".join(f"({quoted(c)}, {quoted(d)}, {quoted(t)})" for c, d, t in REFRESH)
    return f"""tables AS ({tables}),
        refresh AS (
            SELECT w.control, t.last_modified_time AS last_refresh_ms
            FROM (VALUES {wanted}) AS w(control, dataset_id, table_id), tables AS t
            WHERE t.dataset_id = w.dataset_id AND t.table_id = w.table_id),"""


def unified_sql(as_of: dt.date, days: int) -> str:
    controls = [c for name, c in standard_control_sql(as_of).items() if name != "F12-M"]
    ctes = stand_in_ctes([c.source for c in controls]) + refresh_ctes()
    return report_sql(controls, as_of, days, ctes, ", refresh.last_refresh_ms", "LEFT JOIN refresh USING (control)")
