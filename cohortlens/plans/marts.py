"""Customer dimension and the five business facts."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (ACTIVE_STATUS, ACTIVE_TRIAL, CHURNED, CONVERTED, INACTIVE_STATUS,
                      UNRESOLVED, Config)
from ..functions.scoring import (flags_sum, pattern_map, recency_points, saturating_ratio,
                                 tier_label)
from ..functions.text import clean_text, normalize_key
from ..operators.checks import KeyCheck
from ..operators.cohorts import cohort_conversion, outcome_label
from ..operators.intervals import (active_by_month, first_period, month_of, month_spine,
                                   without_successor)
from ..operators.revenue import churn_trigger, retention_ratios, retention_rollup, revenue_parts
from ..operators.windows import attach_group_avg, period_delta

KEY = ["company", "addon_name"]
DIM_COLS = ["company", "addon_name", "cloud_id", "cloud_site_hostname", "tech_contact_email",
            "status", "license_type", "tier", "hosting", "distinct_users", "total_events",
            "first_seen", "last_seen", "match_type"]


def dim_customers(entity: DataFrame) -> DataFrame:
    """Presentation projection of the customer entity."""
    return entity.select(*DIM_COLS)


def dim_keys(dim: DataFrame) -> DataFrame:
    """Known (company, product) keys of the dimension that a licence row can match.

    Rows labelled unresolved are, by construction, activity keys that no licence has, so no licence
    row can ever match them; leaving them out changes no join result.
    """
    return (dim.filter(F.col("match_type") != F.lit(UNRESOLVED))
            .select(F.col("company"), clean_text("addon_name").alias("addon_name"))
            .filter(F.col("company").isNotNull() & F.col("addon_name").isNotNull()))


def _in_dimension(df: DataFrame, dim: DataFrame | None) -> DataFrame:
    """Keep rows whose (company, product) is a customer of the dimension.

    Without ``dim`` no filter is applied: every licence key with a known company and product is a customer
    of the dimension built from the same licences, so the semi-join would remove nothing.
    """
    return df if dim is None else df.join(dim_keys(dim), KEY, "left_semi")


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


# ---------------------------------------------------------------------------------------------
# M08 active customers
# ---------------------------------------------------------------------------------------------

def customer_intervals(licenses: DataFrame, dim: DataFrame | None) -> DataFrame:
    """Licence maintenance intervals of customers in the dimension (key known, start known)."""
    src = licenses.select(
        normalize_key("company").alias("company"), clean_text("addon_name").alias("addon_name"),
        "status", "maintenance_start_date", "maintenance_end_date",
    ).filter(F.col("company").isNotNull() & F.col("addon_name").isNotNull()
             & F.col("maintenance_start_date").isNotNull())
    return _in_dimension(src, dim)


def _active_status(c: str = "status") -> Column:
    return F.upper(F.col(c)) == F.lit(ACTIVE_STATUS)


def churned_by_month(intervals: DataFrame, month: str = "month",
                     open_end=None) -> DataFrame:
    """Distinct companies per (month of end, product) with an ended interval and no ACTIVE, valid
    interval of the same key starting strictly after that end.

    Candidates are first reduced to one row per (key, end month) holding the latest end: a key is
    churned in a month exactly when that latest end is not before the key's latest valid ACTIVE
    start. Both sides of the join are then key-grain aggregates, so a hot key cannot skew it.
    """
    from ..config import OPEN_END_DATE
    open_end = open_end or OPEN_END_DATE
    cands = (intervals.filter(F.col("maintenance_end_date").isNotNull())
             .groupBy(*KEY, month_of("maintenance_end_date").alias(month))
             .agg(F.max("maintenance_end_date").alias("maintenance_end_date")))
    valid = _active_status() & (F.coalesce(F.col("maintenance_end_date"), F.lit(open_end))
                                >= F.col("maintenance_start_date"))
    churned = without_successor(cands, intervals, KEY, "maintenance_end_date",
                                "maintenance_start_date", valid)
    return churned.groupBy(month, "addon_name").agg(F.count(F.lit(1)).alias("churned_customers"))


def active_customers(licenses: DataFrame, dim: DataFrame | None, cfg: Config = Config()) -> DataFrame:
    """Per (month, product): active customers (ACTIVE and covered through month end), new
    customers (first start in the month), churned customers (ended, no later ACTIVE start), and the
    change in active count from the previous present month.

    Months come from licence starts only, and months without an active customer are absent (the
    counts start from the active side).
    """
    iv = customer_intervals(licenses, dim)
    spine = month_spine(iv, "maintenance_start_date")
    active = active_by_month(iv.filter(_active_status()), spine, ["addon_name"], "company",
                             "maintenance_start_date", "maintenance_end_date",
                             out="active_customer_count", open_end=cfg.open_end_date)
    new = first_period(iv, KEY, "maintenance_start_date", ["addon_name"], out="new_customers")
    churned = churned_by_month(iv, open_end=cfg.open_end_date)
    combined = (active.join(new, ["month", "addon_name"], "left")
                .join(churned, ["month", "addon_name"], "left")
                .select("month", "addon_name", "active_customer_count",
                        F.coalesce("new_customers", F.lit(0)).alias("new_customers"),
                        F.coalesce("churned_customers", F.lit(0)).alias("churned_customers")))
    return period_delta(combined, ["addon_name"], "month", "active_customer_count", "mom_change")


# ---------------------------------------------------------------------------------------------
# M09 trial conversion
# ---------------------------------------------------------------------------------------------

def trial_conversion(trials: DataFrame) -> DataFrame:
    """Per (trial start month, product) cohort: started, converted, rate, mean and median days
    to convert over converted trials. Trials without a start date are left out."""
    dated = trials.filter(F.col("trial_start_date").isNotNull()).withColumn(
        "month", month_of("trial_start_date"))
    return cohort_conversion(dated, ["month", "addon_name"], "is_trial", "converted",
                             "days_to_convert")


# ---------------------------------------------------------------------------------------------
# M10 churn and net revenue retention
# ---------------------------------------------------------------------------------------------

def cancellations(events: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Cancel events per (month, company, product)."""
    return (events.filter(F.col("event_type") == F.lit(cfg.cancel_event))
            .select(month_of("event_time").alias("month"),
                    normalize_key("user_property_company").alias("company"),
                    clean_text("product").alias("addon_name"))
            .groupBy("month", "company", "addon_name")
            .agg(F.count(F.lit(1)).alias("subscription_cancelled_events")))


def customer_revenue(transactions: DataFrame, licenses: DataFrame, dim: DataFrame | None,
                     events: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Customer-month revenue measures and cancel counts.

    Sales are shuffled once, on the licence and product that attach them to their company, and summed per
    (month, product, company) in the tasks of that join before the next shuffle. A licence with a third of
    all sales makes one large join partition, which adaptive execution splits (skew join). Licences are
    deduplicated to distinct (licence, product, company), so a repeated licence row cannot multiply amounts.
    """
    tx = (transactions
          .filter(F.col("sale_date").isNotNull() & F.col("vendor_amount").isNotNull()
                  & F.col("license_id").isNotNull())
          .select("license_id", clean_text("addon_name").alias("addon_name"),
                  month_of("sale_date").alias("month"),
                  normalize_key("sale_type").alias("sale_type"), "vendor_amount")
          .filter(F.col("addon_name").isNotNull()))
    lic = (licenses.select("license_id", clean_text("addon_name").alias("addon_name"),
                           normalize_key("company").alias("company"))
           .filter(F.col("company").isNotNull() & F.col("license_id").isNotNull()
                   & F.col("addon_name").isNotNull())
           .distinct())
    sales = tx.join(_in_dimension(lic, dim), ["license_id", "addon_name"], "inner")
    monthly = revenue_parts(sales, ["month", "addon_name", "company"], F.col("sale_type"),
                            F.col("vendor_amount"), cfg.recurring_sale_types,
                            cfg.expansion_sale_type, cfg.contraction_sale_type,
                            cfg.refund_sale_type, cfg.money_type)
    ce = cancellations(events, cfg)
    return (monthly.join(ce, ["month", "company", "addon_name"], "left")
            .withColumn("subscription_cancelled_events",
                        F.coalesce("subscription_cancelled_events", F.lit(0))))


def churn_and_nrr(transactions: DataFrame, licenses: DataFrame, dim: DataFrame | None,
                  events: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Per (sale month, product): mrr, churned_mrr, expansion_mrr, contraction_mrr,
    beginning_mrr (previous present month), nrr, churn_rate."""
    cm = customer_revenue(transactions, licenses, dim, events, cfg)
    churned = churn_trigger(F.col("refund_mrr"), F.col("subscription_cancelled_events"),
                            cfg.refund_sign)
    rolled = retention_rollup(cm, "month", ["addon_name"], churned)
    return retention_ratios(rolled, "month", ["addon_name"])


# ---------------------------------------------------------------------------------------------
# M11 feature adoption
# ---------------------------------------------------------------------------------------------

ADOPTION_AVERAGES = (
    ("avg_checklist_items_created", "checklist_items_created"),
    ("avg_checklist_items_completed", "checklist_items_completed"),
    ("avg_timesheets_submitted", "timesheets_submitted"),
    ("avg_time_logged", "time_logged"),
    ("avg_days_active", "active_days"),
    ("avg_distinct_users", "distinct_users"),
)
USAGE_MEASURES = ["total_events", "distinct_users", "distinct_sessions", "first_event_date",
                  "last_event_date", "active_days"]


def lifecycle_signals(trials: DataFrame) -> DataFrame:
    """Per (company, product): ever converted, ever inactive (1/0)."""
    return trials.groupBy("company", "addon_name").agg(
        F.max(F.when(F.col("converted"), F.lit(1)).otherwise(F.lit(0))).alias("has_converted"),
        F.max(F.when(F.upper("current_status") == F.lit(INACTIVE_STATUS), F.lit(1))
              .otherwise(F.lit(0))).alias("has_inactive_status"))


def _uninstall_column(cfg: Config) -> str:
    return next(name for name, evt in cfg.lifecycle_counters if evt == cfg.uninstall_event)


def feature_outcomes(usage: DataFrame, signals: DataFrame, cfg: Config = Config(),
                     check: KeyCheck | None = None) -> DataFrame:
    """Usage per (company, product) labelled converted / churned / active_trial (M11 without the
    group averages). ``signals``: :func:`lifecycle_signals`."""
    cfg.check_products()
    sig = signals.withColumnsRenamed({"company": "_c", "addon_name": "_a"})
    u = usage.withColumnRenamed("product", "addon_name")
    if check is not None:
        u = check.left(u)
    src = u.join(sig, (u.company == sig._c) & (u.addon_name == sig._a), "left")
    if check is not None:
        src = check.joined(src, F.lit(True))
    outcome = outcome_label([
        (F.coalesce("has_converted", F.lit(0)) == 1, CONVERTED),
        ((F.coalesce("has_inactive_status", F.lit(0)) == 1)
         | (F.col(_uninstall_column(cfg)) > 0), CHURNED),
    ], ACTIVE_TRIAL)
    counters = cfg.feature_columns + cfg.lifecycle_columns
    return src.select("company", "addon_name", outcome.alias("outcome"), *USAGE_MEASURES, *counters)


def feature_adoption(outcomes: DataFrame, averages=ADOPTION_AVERAGES) -> DataFrame:
    """:func:`feature_outcomes` with the mean of six measures over its (product, outcome) group on
    every row."""
    return attach_group_avg(outcomes, ["addon_name", "outcome"], dict(averages))


# ---------------------------------------------------------------------------------------------
# M12 customer health
# ---------------------------------------------------------------------------------------------

def customer_health(profile: DataFrame, as_of=None, cfg: Config = Config()) -> DataFrame:
    """0-100 health per customer = recency + engagement + feature adoption + licence health
    (25 points each), and its tier. ``as_of`` replaces the wall clock (default: current_date).

    ``profile`` is :func:`.intermediate.customer_profile`. Activity without a company is nobody's usage: it
    scores as no usage.
    """
    cfg.check_products()
    today = _as_of(as_of if as_of is not None else cfg.as_of)
    named = F.col("company").isNotNull()
    feats = cfg.feature_columns
    src = profile.filter(F.col("addon_name").isNotNull()).select(
        *KEY, "match_type", "tier", F.col("status").alias("_dim_status"),
        F.col("trial_status").alias("current_status"), F.col(cfg.license_end_column).alias("_end"),
        *[F.when(named, F.col(c)).alias(c) for c in ("last_event_date", "distinct_users", *feats)])
    status = F.upper(F.coalesce(F.coalesce("_dim_status", "current_status"), F.lit("")))
    end = F.col("_end")
    limit = pattern_map("tier", cfg.tier_limits, cfg.tier_other_limit, None)
    users = F.coalesce("distinct_users", F.lit(0))
    engagement = F.when(limit.isNull(), F.lit(float(cfg.tier_null_score))).otherwise(
        saturating_ratio(users, limit, cfg.engagement_cap))
    full, partial = cfg.license_points
    horizon = F.date_add(today, cfg.license_horizon_days)
    active = status == F.lit(ACTIVE_STATUS)
    scored = src.select(
        "company", "addon_name", "match_type",
        recency_points("last_event_date", today, cfg.recency_bands).alias("recency_score"),
        engagement.alias("engagement_score"),
        (F.least(flags_sum(feats), F.lit(cfg.feature_score_cap)) * F.lit(cfg.feature_score_points))
        .alias("feature_adoption_score"),
        F.when(active & (end > horizon), F.lit(full)).when(active & (end <= horizon), F.lit(partial))
        .otherwise(F.lit(0)).alias("license_health_score"),
    )
    total = (F.col("recency_score") + F.col("engagement_score") + F.col("feature_adoption_score")
             + F.col("license_health_score"))
    return scored.select(
        "company", "addon_name", "match_type", "recency_score", "engagement_score",
        "feature_adoption_score", "license_health_score", total.alias("health_score"),
        tier_label(total, cfg.health_tiers, cfg.health_floor_tier).alias("health_tier"))
