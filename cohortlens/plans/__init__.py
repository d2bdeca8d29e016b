"""Data products M01-M16 and the layered build."""

from .insights import (conversion_by_product, coverage_by_match_type, days_to_convert_check,
                       engagement_by_outcome)
from .intermediate import customer_entity, feature_usage, latest_licences, trial_lifecycle
from .marts import (active_customers, churn_and_nrr, customer_health, dim_customers,
                    feature_adoption, trial_conversion)
from .layers import LAYERS, build_all, models
from .staging import stage_events, stage_licenses, stage_transactions

__all__ = [
    "LAYERS", "active_customers", "build_all", "churn_and_nrr", "conversion_by_product",
    "coverage_by_match_type", "customer_entity", "customer_health", "days_to_convert_check",
    "dim_customers", "engagement_by_outcome", "feature_adoption", "feature_usage",
    "latest_licences", "models", "stage_events", "stage_licenses", "stage_transactions",
    "trial_conversion", "trial_lifecycle",
]
