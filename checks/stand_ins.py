"""Source tables of the standard controls, derived from the test tables.

Each entry is (base table, select list). The select lists use SQL that Spark and DuckDB read alike, so
both sides of a check start from the same rows and differ only in how they count them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAND_INS: dict[str, tuple[str, list[str]]] = {
    "control_a02_fx_completeness.output_fx_completeness_snb_control_monthly_data": (
        "orders",
        [
            "CAST(o_orderdate AS DATE) AS current_commissioning_confirmed_date",
            "CASE o_orderstatus WHEN 'F' THEN 'Review for charges' WHEN 'P' THEN 'Timing issue - active billing "
            "billing task - check in the next control run' ELSE 'No action' END AS category1",
        ],
    ),
    "control_a04q_rebill.alteryx_output": (
        "lineitem",
        [
            "l_shipdate AS crc_created_on",
            "CASE l_returnflag WHEN 'A' THEN 'Exception, SAP data found but totals mismatch' WHEN 'R' THEN "
            "'SAP data not found' ELSE NULL END AS sap_exception",
        ],
    ),
    "control_a06m_leases.vw_control_monthly": (
        "lineitem",
        [
            "l_shipdate AS contract_start_date",
            "CASE WHEN l_tax < 0.01 THEN NULL ELSE l_returnflag <> 'A' END AS billed_as_expected",
            "l_quantity > 40 AS lease_cancelled",
            "l_discount > 0.085 AS wholesale_part_of_retail_lease",
            "CASE WHEN l_returnflag = 'N' THEN 'PAID-1' WHEN l_linestatus = 'O' THEN 'X-FREE-1' ELSE 'x-free-1' END "
            "AS lease_contract_number",
            "nullif(l_linenumber, 1) - 2 AS contract_value",
        ],
    ),
    "a15q_extract": ("orders", ["o_orderdate AS billing_task_completed_on"]),
    "control_a17_m_fx_retail_early_terminations_fees.ETF_control_pulse_and_sdp_fees_calculated": (
        "lineitem",
        [
            "l_shipdate AS billing_task_completed_on",
            "nullif(l_discount, 0.0) AS sap_net_value",
            "CASE l_returnflag WHEN 'R' THEN 'Vessel is inside committment period' WHEN 'A' THEN 'Vessel is out of "
            "contract' ELSE NULL END AS is_vessel_ooc",
        ],
    ),
    "chv_extract": (
        "orders",
        [
            "o_orderdate AS charterer_start_date",
            "CASE o_orderpriority WHEN '1-URGENT' THEN 'Review for charges - Not found in billing' ELSE 'Found' END "
            "AS check_for_charterer_plan_billied",
        ],
    ),
    "control_e05w.output_data": (
        "lineitem",
        [
            "l_shipdate AS activation_date",
            "CASE l_linestatus WHEN 'O' THEN 'Review' ELSE NULL END AS review_required",
        ],
    ),
    "control_f01_m_pulse_projects_reconciliation.control_monthly_data": (
        "orders",
        [
            "CAST(o_orderdate AS DATE) AS project_implementation_confirmed_date",
            "CASE o_orderpriority WHEN '1-URGENT' THEN 'Contract change' WHEN '2-HIGH' THEN 'New installation' "
            "WHEN '3-MEDIUM' THEN 'Upgrade installation' ELSE 'Other' END AS project_type",
            "CASE o_orderstatus WHEN 'F' THEN 'No billing available - needs review' "
            "WHEN 'P' THEN 'Old billing - needs review' "
            # Ends like the two that count and isn't one of them.
            "ELSE CASE WHEN o_custkey % 3 = 0 THEN 'Other billing - needs review' ELSE 'Billed' END END AS billing_status",
            "CASE WHEN o_totalprice < 100000 THEN NULL WHEN o_totalprice > 400000 THEN 'Stopped' ELSE 'Active' END "
            "AS project_status",
            "CASE WHEN o_totalprice > 350000 THEN 'Billed in arrears' ELSE 'Not billed in arrears' END "
            "AS billed_arrears",
        ],
    ),
    "control_f12m_btp_suspense.tableau_summary": (
        "lineitem",
        [
            "CAST(l_shipdate AS DATE) AS chargestartdate",
            "nullif(l_linenumber, 7) AS errormessageid",
            "CAST(nullif(l_quantity, 5.0) AS BIGINT) AS countoferrors",
        ],
    ),
    "fc01q_extract": (
        "orders",
        [
            "o_orderdate AS commissioning_confirm_date",
            "CASE o_orderpriority WHEN '3-MEDIUM' THEN 'Review needed - no charges matching with Vessel ID' "
            "ELSE NULL END AS pulse_vs_nuda_category_1",
        ],
    ),
    "control_gx4.output_control_outcomes": (
        "lineitem",
        [
            "l_shipdate AS control_date",
            "CASE l_linestatus WHEN 'F' THEN 'Usage' ELSE 'Billing' END AS control_group",
            "CASE l_returnflag WHEN 'A' THEN 'DAL vs BTP Usage by SSPC' ELSE NULL END AS control_name",
            "CASE WHEN l_linenumber >= 4 THEN 'Difference greater than 2.5%' ELSE 'None' END AS exception_type",
        ],
    ),
    "ime_suspense.IME_Tableau_Summary": (
        "lineitem",
        [
            "CAST(l_shipdate AS DATE) AS chargestartdate",
            "nullif(l_returnflag, 'N') AS errormessageid",
            "nullif(l_linenumber, 3) AS countoferrors",
        ],
    ),
    "control_ime_sv.IME_SV_Summary": (
        "lineitem",
        [
            "CAST(l_shipdate AS DATE) AS ime_ime_file_date",
            "l_returnflag AS traffic_type",
            "l_linestatus AS ime_acquisitionportal",
            "CAST(l_linenumber AS BIGINT) AS files_collected",
            "CAST(nullif(l_quantity, 50.0) AS BIGINT) AS ime_totrecsrecvd",
            "CAST(l_quantity AS BIGINT) - 25 AS ime_v_sv_difference",
        ],
    ),
    "control_pr1_provisioning.controls_history": (
        "orders",
        [
            "o_orderdate AS control_timestamp",
            "CASE o_orderpriority WHEN '1-URGENT' THEN 'BGAN' WHEN '2-HIGH' THEN 'Classic Aero' WHEN '3-MEDIUM' "
            "THEN 'Fleet Mail' WHEN '4-NOT SPECIFIED' THEN 'GX' ELSE 'Unknown' END AS product_group",
            "CASE o_orderstatus WHEN 'F' THEN 'Bill no service' WHEN 'P' THEN 'Status mismatch' ELSE 'No exception' "
            "END AS exception_type",
        ],
    ),
    "control_var_01_leases.monthly_control_output_for_review2": (
        "lineitem",
        [
            "l_shipdate AS order_date",
            "CASE l_returnflag WHEN 'R' THEN 'Review needed?' WHEN 'A' THEN 'HP - billed in last 3 months' ELSE NULL "
            "END AS category_1",
            "CASE l_linestatus WHEN 'O' THEN 'HP - billed in last 3 months' ELSE 'Review needed?' END "
            "AS billed_in_sv_category",
        ],
    ),
    "control_x01b_retail_fx_temprarary_stopped_vessels_review.control_output_data_temp_stop_vessels": (
        "orders",
        [
            "CAST(o_orderdate AS DATE) AS stopped_confirmed_date",
            "CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'Review - active temp stop vessel, why billed with "
            "original charges' WHEN '5-LOW' THEN 'Review - why billed with suspended charges although they are "
            "reactivated' ELSE 'Closed' END AS category1",
        ],
    ),
}

# Table metadata: which test table's newest row stands for each table's modification time. The
# usage table is left out, and one name differs from the mapped one in letter case only.
METADATA: list[tuple[str, str, str, str]] = [
    ("pulse", "vw_project_tasks", "orders", "o_orderdate"),
    ("control_a04q_rebill", "alteryx_output", "lineitem", "l_shipdate"),
    ("control_a06m_leases", "dim_lease_history", "lineitem", "l_shipdate"),
    ("billing_src", "derived_attribute_array", "events", "ts"),
    ("control_e05w", "output_data", "lineitem", "l_shipdate"),
    ("control_f12m_btp_suspense", "sim_tracker", "events", "ts"),
    ("pulse_src", "vessel", "events", "ts"),
    ("ime_suspense", "eps_suspense", "events", "ts"),
    ("control_ime_sv", "ime_summary", "lineitem", "l_shipdate"),
    ("control_pr1_provisioning", "controls_history", "orders", "o_orderdate"),
    ("control_var_01_leases", "output_var_leases_alteryx_data", "lineitem", "l_shipdate"),
]


def stand_in_tables(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    base_table = cache(lambda base: spark.read.parquet(f"{sf_dir}/{base}.parquet"))

    def read(name: str) -> DataFrame:
        base, columns = STAND_INS[name]
        return base_table(base).selectExpr(*columns)

    return read


def stand_in_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata rows whose times are the newest time stamps of the test tables; one scan per table."""
    parts = []
    for base, column in dict.fromkeys((base, column) for _, _, base, column in METADATA):
        names = [F.struct(F.lit(d).alias("dataset_id"), F.lit(t).alias("table_id")) for d, t, b, _ in METADATA if b == base]
        newest = spark.read.parquet(f"{sf_dir}/{base}.parquet").agg(F.max(column).alias("newest"))
        millis = F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ '1970-01-01'"), F.col("newest"))
        parts.append(newest.select(millis.alias("last_modified_time"), F.inline(F.array(*names))))
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first
