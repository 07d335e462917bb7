"""Dashboard series and their headline figures, computed in Spark before anything is shown.

Each series has a function of its own; the figures over a series are one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.functions import first_match, guarded_pct
from outlay.params import DEFAULTS, Thresholds

# Score bands, their filter names, histogram shape and list lengths.
SCORE_BANDS = {
    "Critical": (80, None), "High": (60, 80), "Medium": (40, 60), "Low": (None, 40),
}
HIGH_RISK, MEDIUM_RISK = 80, 60
VENDOR_HIGH, VENDOR_MEDIUM = 70, 50
HISTOGRAM_BINS, SCORE_LIMIT = 20, 100
LISTED_VENDORS = 10


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def monthly_expenses(fact: DataFrame) -> DataFrame:
    """Spending per month; expenses outside the calendar have no month and are left out."""
    return (
        fact.filter(F.col("budget_month_key").isNotNull())
        .groupBy("budget_month_key").agg(F.sum("amount").alias("total_expenses"))
        .orderBy("budget_month_key")
    )


def monthly_expense_figures(fact: DataFrame) -> DataFrame:
    total = F.col("total_expenses").cast("double")
    month = F.col("budget_month_key")
    return monthly_expenses(fact).agg(
        F.count(F.lit(1)).alias("months"),
        F.avg(total).alias("mean_month"),
        F.max_by(month, F.struct(total, _earliest(month))).alias("highest_month"),
        F.max(total).alias("highest_total"),
        F.min_by(month, F.struct(total, month)).alias("lowest_month"),
        F.min(total).alias("lowest_total"),
        F.stddev_samp(total).alias("volatility"),
    )


def _earliest(month: Column) -> Column:
    """Orders 'yyyy-MM' texts from latest to earliest, to break ties of a maximum."""
    return -F.regexp_replace(month, "-", "").cast("int")


def signals_by_rule(signals: DataFrame) -> DataFrame:
    """Signals per rule and their share, most frequent first."""
    counts = signals.groupBy("rule_name").agg(F.count(F.lit(1)).alias("signal_count"))
    total = signals.agg(F.count(F.lit(1))).scalar()
    return counts.select(
        "rule_name", "signal_count", _share(F.col("signal_count"), total).alias("share_pct")
    ).orderBy(F.col("signal_count").desc(), "rule_name")


def signals_by_rule_figures(signals: DataFrame) -> DataFrame:
    counts = signals.groupBy("rule_name").agg(F.count(F.lit(1)).alias("n"))
    largest = F.max("n")
    return counts.agg(
        F.sum("n").alias("total_signals"),
        F.min_by("rule_name", F.struct(-F.col("n"), F.col("rule_name"))).alias("top_rule"),
        largest.alias("top_rule_signals"),
        _share(largest, F.sum("n")).alias("top_rule_pct"),
        F.count(F.lit(1)).alias("active_rules"),
        F.avg("n").alias("mean_per_rule"),
    )


def score_histogram(signals: DataFrame) -> DataFrame:
    """Signals per score bin: equal bins over [0, 100), and one last bin for 100 itself."""
    width = SCORE_LIMIT / HISTOGRAM_BINS
    number = F.width_bucket(
        F.col("score").cast("double"), F.lit(0.0), F.lit(float(SCORE_LIMIT)), F.lit(HISTOGRAM_BINS)
    )
    return (
        signals.filter(F.col("score").isNotNull())
        .groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("signal_count"))
        .select("bin", ((F.col("bin") - 1) * width).alias("bin_start"), "signal_count")
        .orderBy("bin")
    )


def score_figures(signals: DataFrame) -> DataFrame:
    """Mean, median, deviation and band counts, from the counts per distinct score."""
    per_score = signals.groupBy(F.col("score").cast("double").alias("score")).agg(
        F.count(F.lit(1)).alias("n")
    )
    score, n = F.col("score"), F.col("n")
    counted = F.when(score.isNotNull(), n).otherwise(0)
    total, rows = F.sum(counted), F.sum(n)
    high = F.sum(F.when(score >= HIGH_RISK, n).otherwise(0))
    medium = F.sum(F.when((score >= MEDIUM_RISK) & (score < HIGH_RISK), n).otherwise(0))
    low = F.sum(F.when(score < MEDIUM_RISK, n).otherwise(0))
    mean = F.try_divide(F.sum(score * n), total)
    variance = F.try_divide(F.sum(score * score * n) - total * mean * mean, total - 1)
    return per_score.agg(
        mean.alias("mean_score"),
        F.percentile("score", 0.5, F.col("n")).alias("median_score"),
        F.sqrt(F.greatest(variance, F.lit(0.0))).alias("stddev_score"),
        high.alias("high_count"), _share(high, rows).alias("high_pct"),
        medium.alias("medium_count"), _share(medium, rows).alias("medium_pct"),
        low.alias("low_count"), _share(low, rows).alias("low_pct"),
    )


def signals_over_time(signals: DataFrame) -> DataFrame:
    return (
        signals.filter(F.col("signal_date").isNotNull())
        .groupBy("signal_date").agg(F.count(F.lit(1)).alias("signal_count"))
        .orderBy("signal_date")
    )


def signals_over_time_figures(signals: DataFrame) -> DataFrame:
    """Span, mean, peak day and trend: the last day's count against the first day's."""
    day, n = F.col("signal_date"), F.col("signal_count")
    last, first = F.max_by("signal_count", "signal_date"), F.min_by("signal_count", "signal_date")
    return signals_over_time(signals).agg(
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        F.avg(n).alias("mean_per_day"),
        F.min_by(day, F.struct(-n, day)).alias("peak_day"),
        F.max(n).alias("peak_signals"),
        F.count(F.lit(1)).alias("active_days"),
        first_match((last > first, "Increasing"), (last < first, "Decreasing"), default="Stable").alias(
            "trend"
        ),
    )


def budget_variance_figures(variance: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    pct, rows = F.col("variance_percentage"), F.count(F.lit(1))
    over = F.count_if(pct > limits.over_budget_pct)
    under = F.count_if(pct < limits.under_budget_pct)
    on_target = F.count_if(pct.between(limits.under_budget_pct, limits.over_budget_pct))
    return variance.agg(
        rows.alias("department_months"),
        over.alias("over_budget"), _share(over, rows).alias("over_budget_pct"),
        under.alias("under_budget"), _share(under, rows).alias("under_budget_pct"),
        on_target.alias("on_target"), _share(on_target, rows).alias("on_target_pct"),
        F.avg(pct).alias("mean_variance_pct"),
        F.min_by("dept_name", F.struct(-pct, F.col("dept_name"))).alias("highest_department"),
        F.max(pct).alias("highest_variance_pct"),
    )


def monthly_budget(variance: DataFrame) -> DataFrame:
    """Budget and actual per month, over department months that belong to a month."""
    return (
        variance.filter(F.col("budget_month_key").isNotNull())
        .groupBy("budget_month_key")
        .agg(F.sum("budget_amount").alias("budget_amount"), F.sum("actual_amount").alias("actual_amount"))
        .orderBy("budget_month_key")
    )


def monthly_budget_figures(variance: DataFrame) -> DataFrame:
    budget, actual = F.sum("budget_amount"), F.sum("actual_amount")
    return monthly_budget(variance).agg(
        budget.alias("total_budget"),
        actual.alias("total_actual"),
        guarded_pct(actual - budget, budget).alias("overall_variance_pct"),
        F.avg(F.col("budget_amount").cast("double")).alias("mean_month_budget"),
        F.avg(F.col("actual_amount").cast("double")).alias("mean_month_actual"),
        F.count(F.lit(1)).alias("months"),
    )


def top_vendors(concentration: DataFrame, count: int = LISTED_VENDORS) -> DataFrame:
    return (
        concentration.orderBy(F.col("total_spend").desc(), "vendor_id").limit(count)
        .select("vendor_id", "vendor_name", "total_spend", "spend_percentage")
    )


def top_vendor_figures(concentration: DataFrame, count: int = LISTED_VENDORS) -> DataFrame:
    listed = top_vendors(concentration, count)
    spend = F.col("total_spend")
    listed_total = listed.agg(F.sum(spend)).scalar()
    return concentration.agg(
        F.count(F.lit(1)).alias("total_vendors"),
        F.sum(spend).alias("all_spend"),
        F.avg(spend.cast("double")).alias("mean_vendor_spend"),
        F.max(spend).alias("top_vendor_spend"),
        F.min_by("vendor_name", F.struct(-spend, F.col("vendor_id"))).alias("top_vendor"),
    ).withColumn("listed_share_pct", guarded_pct(listed_total, F.col("all_spend")))


def vendor_risk_split(concentration: DataFrame) -> DataFrame:
    """Vendors per risk band and their share."""
    score = F.col("concentration_score")
    band = first_match((score >= VENDOR_HIGH, "High"), (score >= VENDOR_MEDIUM, "Medium"), default="Low")
    total = concentration.agg(F.count(F.lit(1))).scalar()
    return concentration.groupBy(band.alias("risk_band")).agg(
        F.count(F.lit(1)).alias("vendor_count")
    ).withColumn("share_pct", _share(F.col("vendor_count"), total))


def rule_names(signals: DataFrame) -> DataFrame:
    """The values of the rule filter."""
    return signals.select("rule_name").distinct()


def filter_signals(signals: DataFrame, band: str | None = None, rule: str | None = None) -> DataFrame:
    """The signal listing, optionally of one risk band and of one rule."""
    listed = signals
    if band is not None:
        low, high = SCORE_BANDS[band]
        if low is not None:
            listed = listed.filter(F.col("score") >= low)
        if high is not None:
            listed = listed.filter(F.col("score") < high)
    if rule is not None:
        listed = listed.filter(F.col("rule_name") == rule)
    return listed.select("rule_name", "entity_type", "entity_name", "signal_date", "score", "details")


def headline(fact: DataFrame, signals: DataFrame, concentration: DataFrame) -> DataFrame:
    """One row: total expenses, signals, high-risk signals and vendors."""
    counted = signals.agg(
        F.count(F.lit(1)).alias("leakage_signals"),
        F.count_if(F.col("score") >= HIGH_RISK).alias("high_risk_signals"),
    )
    return counted.withColumns({
        "total_expenses": fact.agg(F.sum("amount")).scalar(),
        "active_vendors": concentration.agg(F.count(F.lit(1))).scalar(),
    })
