"""Daily control monitoring on Spark: dense date-by-metric counts with period-over-period change."""

from tallygrid.functions.dates import DateSpan, resolve_as_of, same_month
from tallygrid.operators.change import period_change
from tallygrid.operators.counts import grid_counts, sparse_counts, zero_filled_counts
from tallygrid.operators.freshness import file_refresh_times, refresh_times
from tallygrid.operators.grid import date_spine, metric_grid, scaffold
from tallygrid.operators.incidents import incidents
from tallygrid.operators.reshape import unpivot_nonnull, unpivot_rules
from tallygrid.plans.unified import control_counts, unified
from tallygrid.spec import ControlSpec, KeysOf, RefreshSource, Rule

__all__ = [
    "ControlSpec",
    "DateSpan",
    "KeysOf",
    "RefreshSource",
    "Rule",
    "control_counts",
    "date_spine",
    "file_refresh_times",
    "grid_counts",
    "incidents",
    "metric_grid",
    "period_change",
    "refresh_times",
    "resolve_as_of",
    "same_month",
    "scaffold",
    "sparse_counts",
    "unified",
    "unpivot_nonnull",
    "unpivot_rules",
    "zero_filled_counts",
]
