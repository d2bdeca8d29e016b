"""Business configuration: products, events, tiers, sale types, money type.

Everything a deployment may want to change lives in :class:`Config`. ``Config()`` carries the
original model's event vocabulary and scoring rules; product names are deployment data, set with
:meth:`Config.with_products`.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace

# --- Fixed values that must equal the original model's for the same results ---------------------
# Short product names used by the event tracker, mapped to canonical licence product names.
# Product names are deployment data: none are built in (see Config.with_products).
DEFAULT_PRODUCT_ALIASES: tuple[tuple[str, str], ...] = ()
# Automated / QA events that are not user activity.
DEFAULT_SYSTEM_EVENTS = ("automated_test_run", "api_health_check")
# Product slots of the feature counters; Config.with_products puts real product names in them.
CHECKLIST_PRODUCT, TIME_PRODUCT = "CHECKLIST PRODUCT", "TIME TRACKING PRODUCT"
# Product-scoped feature counters: (output column, product slot, event_type).
FEATURE_EVENTS = (
    ("checklist_items_created", CHECKLIST_PRODUCT, "checklist_item_created"),
    ("checklist_items_completed", CHECKLIST_PRODUCT, "checklist_item_completed"),
    ("templates_applied", CHECKLIST_PRODUCT, "checklist_template_applied"),
    ("checklists_exported", CHECKLIST_PRODUCT, "checklist_exported"),
    ("checklists_shared", CHECKLIST_PRODUCT, "checklist_shared"),
    ("timesheets_submitted", TIME_PRODUCT, "timesheet_submitted"),
    ("timesheets_approved", TIME_PRODUCT, "timesheets_approved"),
    ("time_logged", TIME_PRODUCT, "time_logged"),
    ("timers_started", TIME_PRODUCT, "timer_started"),
    ("reports_generated", TIME_PRODUCT, "report_generated"),
)
DEFAULT_FEATURE_COUNTERS = FEATURE_EVENTS
# Lifecycle counters over any product: (output column, event_type).
DEFAULT_LIFECYCLE_COUNTERS = (
    ("onboarding_completed", "onboarding_completed"),
    ("onboarding_started", "onboarding_started"),
    ("subscription_activated", "subscription_activated"),
    ("subscription_cancelled", "subscription_cancelled"),
    ("app_uninstalled", "app_uninstalled"),
)
# Tier label patterns (first match wins) and the seat limit each implies; other labels get 50.
DEFAULT_TIER_LIMITS = (
    ("FREE", 10),
    ("STANDARD", 25),
    ("PRO", 50),
    ("PREMIUM", 100),
    ("ENTERPRISE", 250),
)
DEFAULT_TIER_OTHER_LIMIT = 50
DEFAULT_TIER_NULL_SCORE = 10  # engagement points when the tier is unknown
# Recency bands (days since last event, points); first band that holds wins, else 0.
DEFAULT_RECENCY_BANDS = ((30, 25), (60, 15), (90, 5))
# Licence horizon: ACTIVE and ending more than this many days after as-of -> 25, else ACTIVE -> 15.
DEFAULT_LICENSE_HORIZON_DAYS = 30
DEFAULT_LICENSE_POINTS = (25, 15)
# Health tiers: (minimum score, label) from the top; below the last -> 'critical'.
DEFAULT_HEALTH_TIERS = ((75, "healthy"), (40, "at_risk"))
DEFAULT_HEALTH_FLOOR_TIER = "critical"
# Sale types (upper case) by revenue role.
DEFAULT_RECURRING_SALE_TYPES = ("NEW", "RENEWAL", "UPGRADE")
DEFAULT_EXPANSION_SALE_TYPE = "UPGRADE"
DEFAULT_CONTRACTION_SALE_TYPE = "DOWNGRADE"
DEFAULT_REFUND_SALE_TYPE = "REFUND"
DEFAULT_CANCEL_EVENT = "subscription_cancelled"
DEFAULT_UNINSTALL_EVENT = "app_uninstalled"
# Open-ended intervals end on this date.
OPEN_END_DATE = _dt.date(2999, 12, 31)
# Match labels of the customer entity.
MATCHED, LICENCE_ONLY, UNRESOLVED = "matched_on_company", "marketplace_only", "unresolved"
# Trial outcomes, in precedence order.
CONVERTED, CHURNED, ACTIVE_TRIAL = "converted", "churned", "active_trial"
ACTIVE_STATUS, INACTIVE_STATUS, EVALUATION_TYPE = "ACTIVE", "INACTIVE", "EVALUATION"
# -----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Config:
    """Vocabulary and parameters of the lifecycle model."""

    product_aliases: tuple[tuple[str, str], ...] = DEFAULT_PRODUCT_ALIASES
    system_events: tuple[str, ...] = DEFAULT_SYSTEM_EVENTS
    feature_counters: tuple[tuple[str, str, str], ...] = DEFAULT_FEATURE_COUNTERS
    lifecycle_counters: tuple[tuple[str, str], ...] = DEFAULT_LIFECYCLE_COUNTERS
    tier_limits: tuple[tuple[str, int], ...] = DEFAULT_TIER_LIMITS
    tier_other_limit: int = DEFAULT_TIER_OTHER_LIMIT
    tier_null_score: int = DEFAULT_TIER_NULL_SCORE
    recency_bands: tuple[tuple[int, int], ...] = DEFAULT_RECENCY_BANDS
    license_horizon_days: int = DEFAULT_LICENSE_HORIZON_DAYS
    license_points: tuple[int, int] = DEFAULT_LICENSE_POINTS
    health_tiers: tuple[tuple[int, str], ...] = DEFAULT_HEALTH_TIERS
    health_floor_tier: str = DEFAULT_HEALTH_FLOOR_TIER
    recurring_sale_types: tuple[str, ...] = DEFAULT_RECURRING_SALE_TYPES
    expansion_sale_type: str = DEFAULT_EXPANSION_SALE_TYPE
    contraction_sale_type: str = DEFAULT_CONTRACTION_SALE_TYPE
    refund_sale_type: str = DEFAULT_REFUND_SALE_TYPE
    cancel_event: str = DEFAULT_CANCEL_EVENT
    uninstall_event: str = DEFAULT_UNINSTALL_EVENT
    # Money columns are cast to this type in staging (scale 0 like the warehouse's bare NUMBER).
    money_type: str = "decimal(38,0)"
    # Refunds trigger churn when refund total compares this way to 0 ('>' keeps the original rule).
    refund_sign: str = ">"
    # Date the health score is computed for; None means current_date() at run time.
    as_of: _dt.date | None = None
    # Which end the licence horizon looks at: the latest trial end ("trial", as the original model does) or
    # the latest maintenance end ("maintenance").
    license_end: str = "trial"
    # End date given to open-ended maintenance intervals.
    open_end_date: _dt.date = OPEN_END_DATE
    feature_score_cap: int = 5
    feature_score_points: int = 5
    engagement_cap: int = 25

    def with_(self, **changes) -> "Config":
        return replace(self, **changes)

    def with_products(self, checklist: str, time_tracking: str,
                      aliases: tuple[tuple[str, str], ...] = ()) -> "Config":
        """Name the canonical products (key form) whose feature events are counted, and the short
        names the event tracker uses for products (short -> canonical)."""
        slots = {CHECKLIST_PRODUCT: checklist.upper(), TIME_PRODUCT: time_tracking.upper()}
        counters = tuple((name, slots.get(prod, prod), evt) for name, prod, evt in FEATURE_EVENTS)
        return replace(self, feature_counters=counters,
                       product_aliases=tuple((a.upper(), b.upper()) for a, b in aliases))

    def check_products(self) -> None:
        """Raise unless real products are named: the built-in slots match no event, so every
        product-scoped counter would be 0."""
        unnamed = {prod for _, prod, _ in self.feature_counters} & {CHECKLIST_PRODUCT, TIME_PRODUCT}
        if unnamed:
            raise ValueError(f"name the products of the feature counters (Config.with_products): {sorted(unnamed)}")

    @property
    def license_end_column(self) -> str:
        return {"trial": "latest_trial_end_date", "maintenance": "latest_maintenance_end_date"}[self.license_end]

    @property
    def feature_columns(self) -> list[str]:
        return [name for name, _, _ in self.feature_counters]

    @property
    def lifecycle_columns(self) -> list[str]:
        return [name for name, _ in self.lifecycle_counters]
