"""Metric groups (one row each) and the assembled report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.functions import guarded_pct
from outlay.params import DEFAULTS, Thresholds

# Score bands and the share of flagged spend taken as leakage.
HIGH_RISK = 80
MEDIUM_RISK = 60
HIGH_RISK_VENDOR = 70
LEAKAGE_SHARE = 0.5
TOP_VENDORS = 5


def _or_zero(value: Column) -> Column:
    return F.coalesce(value.cast("double"), F.lit(0.0))


def expense_metrics(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("amount").cast("double").alias("total_expenses"),
        F.avg("amount").cast("double").alias("avg_transaction_amount"),
        F.max("amount").cast("double").alias("max_transaction_amount"),
        F.min("amount").cast("double").alias("min_transaction_amount"),
    )


def signals_per_rule(signals: DataFrame) -> DataFrame:
    """Counts and score sums per rule; the other signal metrics roll this small table up."""
    score = F.col("score")
    return signals.groupBy("rule_name").agg(
        F.count(F.lit(1)).alias("signal_count"),
        F.sum(score.cast("double")).alias("score_sum"),
        F.count_if(score >= HIGH_RISK).alias("high"),
        F.count_if((score >= MEDIUM_RISK) & (score < HIGH_RISK)).alias("medium"),
        F.count_if(score < MEDIUM_RISK).alias("low"),
    )


def signal_metrics(per_rule: DataFrame) -> DataFrame:
    total, score_sum = F.sum("signal_count"), F.sum("score_sum")
    return per_rule.agg(
        F.coalesce(total, F.lit(0)).alias("total_signals"),
        F.coalesce(F.sum("high"), F.lit(0)).alias("high_risk_signals"),
        F.coalesce(F.sum("medium"), F.lit(0)).alias("medium_risk_signals"),
        F.coalesce(F.sum("low"), F.lit(0)).alias("low_risk_signals"),
        _or_zero(score_sum).alias("total_risk_score"),
        _or_zero(F.try_divide(score_sum, total)).alias("avg_risk_score"),
    )


def rule_counts(per_rule: DataFrame) -> DataFrame:
    return per_rule.select("rule_name", "signal_count")


def budget_metrics(variance: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Totals over department months; the over and under counts are department months too."""
    pct = F.col("variance_percentage")
    return variance.agg(
        _or_zero(F.sum("budget_amount")).alias("total_budget"),
        _or_zero(F.sum("actual_amount")).alias("total_actual"),
        _or_zero(F.sum("variance_amount")).alias("total_variance"),
        _or_zero(F.avg(pct)).alias("avg_variance_pct"),
        F.count_if(pct > limits.over_budget_pct).alias("over_budget_departments"),
        F.count_if(pct < limits.under_budget_pct).alias("under_budget_departments"),
    )


def vendor_metrics(concentration: DataFrame) -> DataFrame:
    return concentration.agg(
        F.count(F.lit(1)).alias("total_vendors"),
        _or_zero(F.sum("total_spend")).alias("total_vendor_spend"),
        _or_zero(F.avg("spend_percentage")).alias("avg_spend_percentage"),
        _or_zero(F.max("spend_percentage")).alias("max_spend_percentage"),
        F.count_if(F.col("concentration_score") >= HIGH_RISK_VENDOR).alias("high_risk_vendors"),
    )


def top_vendors(concentration: DataFrame, count: int = TOP_VENDORS) -> DataFrame:
    return (
        concentration.orderBy(F.col("total_spend").desc(), "vendor_id").limit(count)
        .select("vendor_name", "total_spend", "spend_percentage", "concentration_score")
    )


def leakage_estimate(expenses: DataFrame, signals: DataFrame) -> DataFrame:
    """From the expense and signal metric rows: estimated amount, and its share of spend."""
    high_risk = signals.select("high_risk_signals").scalar()
    estimate = F.col("high_risk") * F.col("avg_transaction_amount") * LEAKAGE_SHARE
    return (
        expenses.withColumn("high_risk", high_risk)
        .select("total_expenses", F.when(F.col("high_risk") > 0, estimate).otherwise(F.lit(0.0)).alias(
            "estimated_potential_leakage"
        ))
        .select(
            "estimated_potential_leakage",
            guarded_pct(F.col("estimated_potential_leakage"), F.col("total_expenses")).alias(
                "leakage_percentage"
            ),
        )
    )


def _section(row: DataFrame, section: str) -> DataFrame:
    """A one-row metric group as (section, item, metric, value) rows."""
    return row.select([F.col(c).cast("double").alias(c) for c in row.columns]).unpivot(
        [], row.columns, "metric", "value"
    ).select(F.lit(section).alias("section"), F.lit(None).cast("string").alias("item"), "metric", "value")


def metrics_report(
    fact: DataFrame, signals: DataFrame, variance: DataFrame, concentration: DataFrame,
    limits: Thresholds = DEFAULTS,
) -> DataFrame:
    """Every metric as a row (section, item, metric, value); ``item`` names a rule or vendor."""
    per_rule = signals_per_rule(signals)
    expenses, detection = expense_metrics(fact), signal_metrics(per_rule)
    by_rule = per_rule.select(
        F.lit("leakage_by_rule").alias("section"), F.col("rule_name").alias("item"),
        F.lit("signal_count").alias("metric"), F.col("signal_count").cast("double").alias("value"),
    )
    measures = ["total_spend", "spend_percentage", "concentration_score"]
    top = top_vendors(concentration).select(
        F.col("vendor_name").alias("item"), *[F.col(m).cast("double").alias(m) for m in measures]
    )
    top_rows = top.unpivot(["item"], measures, "metric", "value").select(
        F.lit("top_vendors").alias("section"), "item", "metric", "value"
    )
    return reduce(DataFrame.unionByName, [
        _section(expenses, "expenses"),
        _section(detection.drop("total_risk_score"), "leakage_detection"),
        by_rule,
        _section(budget_metrics(variance, limits), "budget_analysis"),
        _section(vendor_metrics(concentration), "vendor_analysis"),
        top_rows,
        _section(leakage_estimate(expenses, detection), "leakage_estimate"),
    ])
