"""The standard controls, as specs.

To add a control, append a ``ControlSpec`` (and a ``RefreshSource`` for its freshness) to the lists
given to the plans.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from tallygrid.functions.conditions import null_or_zero
from tallygrid.functions.dates import same_month
from tallygrid.operators.reshape import unpivot_rules
from tallygrid.spec import ControlSpec, KeysOf, RefreshSource, Rule

# Control ids, source names, metric names, categories and freshness tables. They are
# data, spelled as the sources and the dashboard spell them, odd spellings included.

NOT_APPLICABLE = "n/a"

COMPLETENESS_CATEGORIES = (
    "Review for charges",
    "Timing issue - active billing billing task - check in the next control run",
)
REBILL_EXCEPTIONS = (
    "Exception, SAP data found but totals mismatch",
    "SAP data not found",
)
LEASE_NOT_BILLED = "Not Billed as Planned"
LEASE_UNPRICED = "Unpriced Lease"
FEE_WITHOUT_VALUE = "Null SAP Net Value"
FEE_IN_COMMITMENT = "Vessel is inside committment period"
CHARTERER_NOT_FOUND = "Review for charges - Not found in billing"
PROJECT_TYPES = ("Contract change", "New installation", "Upgrade installation")
PROJECT_BILLING_STATUSES = ("No billing available - needs review", "Old billing - needs review")
COMMISSIONING_REVIEW = "Review needed - no charges matching with Vessel ID"
USAGE_CONTROL = "DAL vs BTP Usage by SSPC"
USAGE_LABEL = "Difference Greater than 2.5%"
USAGE_EXCEPTION = "Difference greater than 2.5%"
SUSPENSE_MEASURES = ("files_collected", "ime_totrecsrecvd", "ime_v_sv_difference")
PROVISIONING_PRODUCTS = ("BGAN", "Classic Aero", "Fleet Mail", "GX", "Inm-C")
PROVISIONING_EXCEPTIONS = (
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
)
VARIABLE_LEASE_REVIEW = ("category_1", "Review needed?")
VARIABLE_LEASE_BILLED = ("Billed_in_SV_category", "HP - billed in last 3 months")
STOPPED_VESSEL_CATEGORIES = (
    "Review - active temp stop vessel, why billed with original charges",
    "Review - why billed with suspended charges although they are reactivated",
)

REFRESH_SOURCES = (
    RefreshSource("A02-Q", "pulse", "vw_project_tasks"),
    RefreshSource("A04-Q", "control_a04q_rebill", "alteryx_output"),
    RefreshSource("A06-M", "control_a06m_leases", "dim_lease_history"),
    RefreshSource("A15-Q", "pulse", "vw_project_tasks"),
    RefreshSource("A17-M", "pulse", "vw_project_tasks"),
    RefreshSource("CH-V", "billing_src", "derived_attribute_array"),
    RefreshSource("E05-W", "control_e05w", "output_data"),
    RefreshSource("F01-M", "pulse", "vw_project_tasks"),
    RefreshSource("F12-M", "control_f12m_btp_suspense", "sim_tracker"),
    RefreshSource("FC01-Q", "pulse_src", "vessel"),
    RefreshSource("GX4-JX", "control_gx4", "output_control_outcomes"),
    RefreshSource("IME01-W", "ime_suspense", "EPS_Suspense"),
    RefreshSource("IME02-W", "control_ime_sv", "ime_summary"),
    RefreshSource("PR-1", "control_pr1_provisioning", "controls_history"),
    RefreshSource("VAR-1", "control_var_01_leases", "output_var_leases_alteryx_data"),
    RefreshSource("X01-B", "pulse_src", "vessel"),
)

# End of the fixed values.


def _details_in_list(
    control: str, source: str, date: str, metric: str, column: str, details: tuple[str, ...], when=None
) -> ControlSpec:
    """Counts rows per category, for a fixed list of categories of interest."""
    return ControlSpec(
        control,
        source,
        date,
        rules=[Rule(metric, F.col(column), when=when)],
        grid=[(metric, detail) for detail in details],
    )


def _single_cell(control: str, source: str, date: str, metric: str, detail: str, when) -> ControlSpec:
    """Counts the rows that meet one condition, in one cell per day."""
    return ControlSpec(control, source, date, rules=[Rule(metric, detail, when=when)], grid=[(metric, detail)])


def completeness() -> ControlSpec:
    return _details_in_list(
        "A02-Q",
        "control_a02_fx_completeness.output_fx_completeness_snb_control_monthly_data",
        "current_commissioning_confirmed_date",
        "Category 1",
        "category1",
        COMPLETENESS_CATEGORIES,
    )


def rebill() -> ControlSpec:
    return _details_in_list(
        "A04-Q",
        "control_a04q_rebill.alteryx_output",
        "crc_created_on",
        "SAP Exception",
        "sap_exception",
        REBILL_EXCEPTIONS,
    )


def leases() -> ControlSpec:
    """A lease can be both unbilled and unpriced, and then counts under both metrics."""
    live = ~F.col("lease_cancelled") & ~F.col("wholesale_part_of_retail_lease")
    free = F.col("lease_contract_number").contains("FREE") & null_or_zero(F.col("contract_value"))
    return ControlSpec(
        "A06-M",
        "control_a06m_leases.vw_control_monthly",
        "contract_start_date",
        rules=[
            Rule(LEASE_NOT_BILLED, NOT_APPLICABLE, when=live & ~F.col("billed_as_expected")),
            Rule(LEASE_UNPRICED, NOT_APPLICABLE, when=live & free),
        ],
        grid=[(LEASE_NOT_BILLED, NOT_APPLICABLE), (LEASE_UNPRICED, NOT_APPLICABLE)],
    )


def billing_tasks() -> ControlSpec:
    """Month to date: early in a month, days of the month before count 0."""
    return _single_cell(
        "A15-Q",
        "a15q_extract",
        "billing_task_completed_on",
        "Billing task completed on",
        "Current month",
        lambda as_of: same_month(F.col("billing_task_completed_on"), as_of),
    )


def termination_fees() -> ControlSpec:
    return ControlSpec(
        "A17-M",
        "control_a17_m_fx_retail_early_terminations_fees.ETF_control_pulse_and_sdp_fees_calculated",
        "billing_task_completed_on",
        rules=[
            Rule(FEE_WITHOUT_VALUE, NOT_APPLICABLE, when=F.col("sap_net_value").isNull()),
            Rule(FEE_IN_COMMITMENT, NOT_APPLICABLE, when=F.col("is_vessel_ooc") == FEE_IN_COMMITMENT),
        ],
        grid=[(FEE_WITHOUT_VALUE, NOT_APPLICABLE), (FEE_IN_COMMITMENT, NOT_APPLICABLE)],
    )


def charterers() -> ControlSpec:
    return _single_cell(
        "CH-V",
        "chv_extract",
        "charterer_start_date",
        "check_for_Charterer_plan_billied",
        CHARTERER_NOT_FOUND,
        F.col("check_for_charterer_plan_billied") == CHARTERER_NOT_FOUND,
    )


def activations() -> ControlSpec:
    return _single_cell(
        "E05-W",
        "control_e05w.output_data",
        "activation_date",
        "Review Required",
        "Review",
        F.col("review_required") == "Review",
    )


def projects() -> ControlSpec:
    """A project without a status is not counted: its status is not known to differ from stopped."""
    return _details_in_list(
        "F01-M",
        "control_f01_m_pulse_projects_reconciliation.control_monthly_data",
        "project_implementation_confirmed_date",
        "Tasks Remaining",
        "project_type",
        PROJECT_TYPES,
        when=F.col("billing_status").isin(*PROJECT_BILLING_STATUSES)
        & (F.col("project_status") != "Stopped")
        & (F.col("billed_arrears") == "Not billed in arrears"),
    )


def suspense_by_error() -> ControlSpec:
    """Defined, but not among the active controls."""
    return _errors_per_message("F12-M", "control_f12m_btp_suspense.tableau_summary")


def commissioning() -> ControlSpec:
    return _single_cell(
        "FC01-Q",
        "fc01q_extract",
        "commissioning_confirm_date",
        "pulse_vs_nuda_category_1",
        COMMISSIONING_REVIEW,
        F.col("pulse_vs_nuda_category_1") == COMMISSIONING_REVIEW,
    )


def usage() -> ControlSpec:
    """The dashboard label and the exception text differ in one capital letter."""
    return _single_cell(
        "GX4-JX",
        "control_gx4.output_control_outcomes",
        "control_date",
        USAGE_CONTROL,
        USAGE_LABEL,
        (F.col("control_group") == "Usage")
        & (F.col("control_name") == USAGE_CONTROL)
        & (F.col("exception_type") == USAGE_EXCEPTION),
    )


def _errors_per_message(control: str, source: str) -> ControlSpec:
    """Sums error counts per message id, for every message id the source ever held."""
    message = F.col("errormessageid")
    return ControlSpec(
        control,
        source,
        "chargestartdate",
        rules=[Rule("ErrorMessageID", message, measure=F.col("countoferrors"))],
        grid=KeysOf(message, {"ErrorMessageID": None}),
    )


def suspense_messages() -> ControlSpec:
    return _errors_per_message("IME01-W", "ime_suspense.IME_Tableau_Summary")


def suspense_files() -> ControlSpec:
    """Three measures turned into metrics, per traffic type and portal."""
    detail = F.concat("traffic_type", F.lit(" - "), "ime_acquisitionportal")
    return ControlSpec(
        "IME02-W",
        "control_ime_sv.IME_SV_Summary",
        "ime_ime_file_date",
        rules=unpivot_rules({name: name for name in SUSPENSE_MEASURES}, detail),
        grid=KeysOf(detail, {name: F.col(name) for name in SUSPENSE_MEASURES}),
    )


def provisioning() -> ControlSpec:
    """The one control without zero fill: days without an incident have no row."""
    return ControlSpec(
        "PR-1",
        "control_pr1_provisioning.controls_history",
        "control_timestamp",
        rules=[Rule(F.col("product_group"), F.col("exception_type"))],
        grid=list(product(PROVISIONING_PRODUCTS, PROVISIONING_EXCEPTIONS)),
        zero_fill=False,
    )


def variable_leases() -> ControlSpec:
    """Two category columns, each with the one value of interest."""
    columns = {VARIABLE_LEASE_REVIEW: "category_1", VARIABLE_LEASE_BILLED: "billed_in_sv_category"}
    return ControlSpec(
        "VAR-1",
        "control_var_01_leases.monthly_control_output_for_review2",
        "order_date",
        rules=[Rule(metric, F.col(column)) for (metric, _), column in columns.items()],
        grid=list(columns),
    )


def stopped_vessels() -> ControlSpec:
    return _details_in_list(
        "X01-B",
        "control_x01b_retail_fx_temprarary_stopped_vessels_review.control_output_data_temp_stop_vessels",
        "stopped_confirmed_date",
        "Category 1",
        "category1",
        STOPPED_VESSEL_CATEGORIES,
    )


def standard_controls() -> list[ControlSpec]:
    """The active controls."""
    return [
        completeness(),
        rebill(),
        leases(),
        billing_tasks(),
        termination_fees(),
        charterers(),
        activations(),
        projects(),
        commissioning(),
        usage(),
        suspense_messages(),
        suspense_files(),
        provisioning(),
        variable_leases(),
        stopped_vessels(),
    ]
