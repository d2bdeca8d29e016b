"""DataFrame -> DataFrame building blocks."""

from .checks import KeyCheck
from .cohorts import cohort_conversion, outcome_label
from .counting import conditional_counts, exclude_values
from .intervals import (active_by_month, first_period, latest_start, month_of, month_spine,
                        without_successor, without_successor_within)
from .ranking import latest_per_key
from .resolution import resolve_entities
from .revenue import churn_trigger, retention_ratios, retention_rollup, revenue_parts
from .windows import attach_group_avg, period_delta

__all__ = [
    "KeyCheck",
    "active_by_month", "attach_group_avg", "churn_trigger", "cohort_conversion",
    "conditional_counts", "exclude_values", "first_period", "latest_per_key", "latest_start",
    "month_of", "month_spine", "outcome_label", "period_delta", "resolve_entities",
    "retention_ratios", "retention_rollup", "revenue_parts", "without_successor",
    "without_successor_within",
]
