"""Summary tables over the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def monthly_expenses(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("budget_month_key")
        .agg(
            F.sum("amount").alias("total_expenses"),
            F.count(F.lit(1)).alias("expense_count"),
            F.avg("amount").alias("avg_expense_amount"),
        )
        .orderBy("budget_month_key")
    )


def dept_expenses(fact: DataFrame, departments: DataFrame) -> DataFrame:
    """Totals per department; aggregated before the name is looked up."""
    totals = fact.groupBy("dept_id").agg(
        F.sum("amount").alias("total_expenses"), F.count(F.lit(1)).alias("expense_count"),
    )
    return (
        totals.join(departments.select("dept_id", "dept_name"), "dept_id", "left")
        .select("dept_id", "dept_name", "total_expenses", "expense_count")
        .orderBy(F.col("total_expenses").desc(), "dept_id")
    )


def campaign_performance(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("campaign_id")
        .agg(
            F.sum("cost").alias("total_cost"),
            F.sum("clicks").alias("total_clicks"),
            F.sum("conversions").alias("total_conversions"),
            F.sum("attributed_revenue").alias("total_revenue"),
        )
        .filter(F.col("total_cost") > 0)
        .withColumn("roas", F.try_divide(F.col("total_revenue").cast("double"), F.col("total_cost").cast("double")))
        .orderBy(F.col("roas").desc(), "campaign_id")
    )
