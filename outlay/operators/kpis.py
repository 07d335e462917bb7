"""Budget variance and vendor concentration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outlay.functions import first_match, guarded_pct
from outlay.params import DEFAULTS, Thresholds

# Concentration scores.
HIGH_SCORE = 90.0
MEDIUM_SCORE = 70.0
LOW_SCORE = 50.0
MINIMAL_SCORE = 20.0


def budget_variance(fact: DataFrame, departments: DataFrame, budgets: DataFrame) -> DataFrame:
    """Actual against budget per department and month that has spending.

    A missing budget counts as 0 and gives a variance of 0 %. Budgeted months without
    spending are absent (see the budget-driven view for those).
    """
    actual = fact.groupBy("dept_id", "budget_month_key").agg(F.sum("amount").alias("actual_amount"))
    budget = budgets.select(
        F.col("dept_id"), F.col("budget_month").alias("budget_month_key"), F.col("budget_amount")
    )
    variance = F.col("actual_amount") - F.col("budget_amount")
    return (
        actual.join(departments.select("dept_id", "dept_name"), "dept_id", "left")
        .join(budget, ["dept_id", "budget_month_key"], "left")
        .withColumn("budget_amount", F.coalesce("budget_amount", F.lit(0)))
        .select(
            "dept_id", "dept_name", "budget_month_key", "budget_amount", "actual_amount",
            variance.alias("variance_amount"),
            guarded_pct(variance, F.col("budget_amount")).alias("variance_percentage"),
        )
    )


def vendor_concentration(fact: DataFrame, vendors: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Spend, share of the grand total and risk score per vendor, largest first."""
    totals = fact.groupBy("vendor_id").agg(
        F.sum("amount").alias("total_spend"),
        F.count(F.lit(1)).alias("transaction_count"),
        F.avg("amount").alias("avg_transaction_amount"),
    )
    # From the vendors' sums; the condition reads all their columns, so that both uses share one grouped read of the fact.
    counted = (F.col("transaction_count") > 0) & (F.col("avg_transaction_amount").isNotNull() | F.col("total_spend").isNull())
    grand_total = totals.agg(F.sum(F.when(counted, F.col("total_spend"))).cast("double")).scalar()
    share = F.col("spend_percentage")
    return (
        totals.join(vendors.select("vendor_id", "vendor_name"), "vendor_id", "left")
        .select(
            "vendor_id", "vendor_name", "total_spend", "transaction_count", "avg_transaction_amount",
            (F.col("total_spend").cast("double") / grand_total * 100).alias("spend_percentage"),
        )
        .withColumn("concentration_score", first_match(
            (share > limits.vendor_high_pct, HIGH_SCORE),
            (share > limits.vendor_medium_pct, MEDIUM_SCORE),
            (share > limits.vendor_low_pct, LOW_SCORE),
            default=MINIMAL_SCORE,
        ))
        .orderBy(F.col("total_spend").desc(), "vendor_id")
    )
