"""The published roll-ups and the days-to-convert reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import safe_ratio


def conversion_by_product(trials: DataFrame) -> DataFrame:
    """All-time trial conversion per product, counted from the lifecycle rows (averaging the
    monthly cohort rates would weight months, not trials)."""
    t, c = F.col("is_trial"), F.col("converted")
    return trials.groupBy(F.col("addon_name").alias("product")).agg(
        F.count_if(t).alias("total_trials"),
        F.count_if(t & c).alias("converted"),
        safe_ratio(F.count_if(t & c), F.count_if(t)).alias("conversion_rate"),
        F.avg(F.when(c, F.col("days_to_convert"))).alias("avg_days_to_convert"),
    )


def coverage_by_match_type(health: DataFrame) -> DataFrame:
    """Customers per match type with their mean health and recency, and their share of all
    customers. The share's window runs over the handful of roll-up rows only.

    The mean health sums the scores as decimals of six places (scores under the default tier limits have
    two), so it does not depend on the order of addition.
    """
    exact = F.sum(F.col("health_score").cast("decimal(28,6)")).cast("double")
    g = health.groupBy("match_type").agg(
        F.count(F.lit(1)).alias("customers"),
        (exact / F.count("health_score")).alias("avg_health_score"),
        F.avg("recency_score").alias("avg_recency_score"))
    return g.withColumn("share_of_customers",
                        F.col("customers").cast("double") / F.sum("customers").over(Window.partitionBy()))


def engagement_by_outcome(adoption: DataFrame) -> DataFrame:
    """Mean users and active days per (product, outcome)."""
    return adoption.groupBy(F.col("addon_name").alias("product"), "outcome").agg(
        F.avg("distinct_users").alias("avg_users"),
        F.avg("active_days").alias("avg_days_active"))


def days_to_convert_check(licenses: DataFrame) -> DataFrame:
    """Days from evaluation start to sale, derived from the dates, against the stored
    ``days_to_convert_eval``: rows, rows where both are known, rows where they differ (NULL-safe)."""
    derived = F.datediff("evaluation_sale_date", "evaluation_start_date").cast("bigint")
    stored = F.col("days_to_convert_eval")
    return licenses.agg(
        F.count(F.lit(1)).alias("licenses"),
        F.count_if(derived.isNotNull() & stored.isNotNull()).alias("compared"),
        F.count_if(~derived.eqNullSafe(stored)).alias("mismatched"))
