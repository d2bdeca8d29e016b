"""Two-level revenue retention (customer-month measures, then period x product ratios)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import safe_ratio


def revenue_parts(df: DataFrame, keys: Sequence[str], sale_type: Column, amount: Column,
                  recurring: Sequence[str], expansion: str, contraction: str,
                  refund: str, money_type: str = "decimal(38,0)") -> DataFrame:
    """Sum ``amount`` by revenue role per ``keys``: mrr (recurring types), expansion, contraction,
    refund, and the total over every type. Sums stay in the money type (exact)."""
    zero = F.lit(0).cast(money_type)

    def part(cond: Column) -> Column:
        return F.sum(F.when(cond, amount).otherwise(zero))

    return df.groupBy(*keys).agg(
        part(sale_type.isin(list(recurring))).alias("mrr"),
        part(sale_type == F.lit(expansion)).alias("expansion_mrr"),
        part(sale_type == F.lit(contraction)).alias("contraction_mrr"),
        part(sale_type == F.lit(refund)).alias("refund_mrr"),
        F.sum(amount).alias("total_vendor_amount"),
    )


def churn_trigger(refund: Column, cancels: Column, refund_sign: str = ">") -> Column:
    """A customer-month churns when its refunds compare to 0 by ``refund_sign`` or it has a cancel."""
    ops = {">": refund > 0, "<": refund < 0, "!=": refund != 0}
    return ops[refund_sign] | (cancels > 0)


def retention_rollup(customer_monthly: DataFrame, period: str, group: Sequence[str],
                     churned: Column) -> DataFrame:
    """Roll customer-months up to (period, group): mrr, churned_mrr (whole customer-month total when
    ``churned``), expansion_mrr, contraction_mrr."""
    zero = F.lit(0)
    return customer_monthly.groupBy(period, *group).agg(
        F.sum("mrr").alias("mrr"),
        F.sum(F.when(churned, F.col("total_vendor_amount")).otherwise(zero)).alias("churned_mrr"),
        F.sum("expansion_mrr").alias("expansion_mrr"),
        F.sum("contraction_mrr").alias("contraction_mrr"),
    )


def retention_ratios(rolled: DataFrame, period: str, group: Sequence[str]) -> DataFrame:
    """beginning_mrr = previous present period's mrr; nrr = (beginning + expansion - contraction -
    churned) / beginning; churn_rate = churned / beginning; ratios are double, NULL on 0/NULL.

    One lag over a report-grain frame (periods x products), reused by all three columns.
    """
    w = Window.partitionBy(*group).orderBy(period)
    r = rolled.withColumn("beginning_mrr", F.lag("mrr", 1).over(w))
    b = F.col("beginning_mrr")
    return r.select(
        period, *group, "mrr", "churned_mrr", "expansion_mrr", "contraction_mrr", "beginning_mrr",
        safe_ratio(b + F.col("expansion_mrr") - F.col("contraction_mrr") - F.col("churned_mrr"), b)
        .alias("nrr"),
        safe_ratio("churned_mrr", b).alias("churn_rate"),
    )
