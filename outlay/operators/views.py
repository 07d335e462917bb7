"""The seven reporting views, and their registration as temp views for SQL users.

Facts are aggregated before the dimensions are joined wherever the result allows it, so the
joins see one row per group and not one per fact row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from outlay.functions import first_match, guarded_pct, guarded_ratio
from outlay.params import DEFAULTS, Thresholds

# Labels and limits of the views.
ROAS_EXCELLENT, ROAS_GOOD, ROAS_EVEN = 3, 2, 1
SCORE_CRITICAL, SCORE_HIGH, SCORE_MEDIUM = 80, 60, 40
RECENT_MONTHS = 3


def risk_level(score: Column) -> Column:
    return first_match(
        (score >= SCORE_CRITICAL, "Critical"), (score >= SCORE_HIGH, "High"),
        (score >= SCORE_MEDIUM, "Medium"), default="Low",
    )


def budget_vs_actual(
    budgets: DataFrame, fact: DataFrame, departments: DataFrame, limits: Thresholds = DEFAULTS,
) -> DataFrame:
    """Every budgeted department month with its spending, 0 where there is none.

    The department id is the dimension's, hence NULL for a department it does not know.
    """
    actual = fact.groupBy("dept_id", F.col("budget_month_key").alias("budget_month")).agg(
        F.sum("amount").alias("spent")
    )
    known = departments.select("dept_id", F.col("dept_id").alias("known_id"), "dept_name")
    spending = budgets.select("dept_id", "budget_month", "budget_amount").join(
        actual, ["dept_id", "budget_month"], "left"
    ).join(known, "dept_id", "left")
    grouped = spending.groupBy(
        "dept_name", F.col("known_id").alias("dept_id"), "budget_month", "budget_amount"
    ).agg(F.coalesce(F.sum("spent"), F.lit(0)).alias("actual_amount"))
    variance = F.col("actual_amount") - F.col("budget_amount")
    pct = F.col("variance_percentage")
    return (
        grouped.withColumns({
            "variance_amount": variance,
            "variance_percentage": guarded_pct(variance, F.col("budget_amount")),
        })
        .withColumn("budget_status", first_match(
            (pct > limits.over_budget_pct, "Over Budget"),
            (pct < limits.under_budget_pct, "Under Budget"),
            default="On Target",
        ))
        .orderBy("dept_name", "budget_month")
    )


def vendor_shares(fact: DataFrame, vendors: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Known vendors with their share of all spending (unknown vendors' included in the total)."""
    totals = fact.groupBy("vendor_id").agg(
        F.count("invoice_id").alias("transaction_count"),
        F.sum("amount").alias("total_spend"),
        F.avg("amount").alias("avg_transaction_amount"),
    )
    # From the vendors' sums; the condition reads all their columns, so that both uses share one grouped read of the fact.
    counted = (F.col("transaction_count") >= 0) & (F.col("avg_transaction_amount").isNotNull() | F.col("total_spend").isNull())
    grand_total = totals.agg(F.sum(F.when(counted, F.col("total_spend"))).cast("double")).scalar()
    share = F.col("spend_percentage")
    return (
        totals.join(vendors.select("vendor_id", "vendor_name", "category"), "vendor_id")
        .select(
            "vendor_name", "vendor_id", "category", "transaction_count", "total_spend",
            "avg_transaction_amount",
            (F.col("total_spend").cast("double") / grand_total * 100).alias("spend_percentage"),
        )
        .withColumn("concentration_risk", first_match(
            (share > limits.vendor_high_pct, "High Risk"),
            (share > limits.vendor_medium_pct, "Medium Risk"),
            (share > limits.vendor_low_pct, "Low Risk"),
            default="Minimal Risk",
        ))
    )


# Vendors are ranked by spend, largest first, equal spend by vendor id. A stage writes ``vendor_shares`` in this order (``write_ranked``).
RANK_ORDER = (("total_spend", "desc"), ("vendor_id", "asc"))


def vendor_concentration(ranks: DataFrame) -> DataFrame:
    """The ranked ``vendor_shares`` (``read_ranked``) in their order."""
    return ranks.orderBy("vendor_rank")


def recent_signals(signals: DataFrame, as_of: Column | None = None) -> DataFrame:
    day = F.current_date() if as_of is None else as_of
    return signals.filter(F.col("signal_date") >= F.add_months(day, -RECENT_MONTHS))


def leakage_flags(signals: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Recent signals with their risk level and the recent counts of their rule and entity type.

    The counts come from two tables of a few rows (one per rule and one per entity type, both
    fixed sets), so no rule's signals are brought together in one task.
    """
    recent = recent_signals(signals, as_of)
    ties = ["signal_id"] if "signal_id" in signals.columns else ["rule_name", "entity_id"]
    counted = recent
    for group in ("rule_name", "entity_type"):
        sizes = recent.groupBy(F.col(group).alias("_group")).agg(F.count(F.lit(1)).alias(f"{group}_size"))
        counted = counted.join(F.broadcast(sizes), F.col(group).eqNullSafe(F.col("_group")), "left").drop("_group")
    return (
        counted.orderBy(F.col("score").desc(), F.col("signal_date").desc(), *ties)
        .select(
            "rule_name", "entity_type", "entity_name", "signal_date", "score", "details",
            risk_level(F.col("score")).alias("risk_level"),
            F.col("rule_name_size").alias("rule_count"),
            F.col("entity_type_size").alias("entity_type_count"),
        )
    )


def campaign_roi(fact: DataFrame, campaigns: DataFrame) -> DataFrame:
    sums = fact.groupBy("campaign_id").agg(
        F.count("spend_id").alias("spend_days"),
        F.sum("cost").alias("total_cost"),
        F.sum("clicks").alias("total_clicks"),
        F.sum("impressions").alias("total_impressions"),
        F.sum("conversions").alias("total_conversions"),
        F.sum("attributed_revenue").alias("total_revenue"),
    )
    roas = F.col("roas")
    return (
        sums.join(campaigns.select("campaign_id", "campaign_name", "channel", "objective"), "campaign_id")
        .withColumns({
            "roas": guarded_ratio(F.col("total_revenue"), F.col("total_cost")),
            "ctr_percentage": guarded_pct(F.col("total_clicks"), F.col("total_impressions")),
            "conversion_rate": guarded_pct(F.col("total_conversions"), F.col("total_clicks")),
        })
        .select(
            "campaign_name", "campaign_id", "channel", "objective", "spend_days", "total_cost",
            "total_clicks", "total_impressions", "total_conversions", "total_revenue", "roas",
            "ctr_percentage", "conversion_rate",
            first_match(
                (roas > ROAS_EXCELLENT, "Excellent"), (roas > ROAS_GOOD, "Good"),
                (roas > ROAS_EVEN, "Break-even"), default="Poor",
            ).alias("roi_category"),
        )
        .orderBy(F.col("roas").desc(), "campaign_id")
    )


def monthly_expense_trends(fact: DataFrame, departments: DataFrame) -> DataFrame:
    """Spending per month and department name against the previous month that has any."""
    by_id = fact.groupBy("budget_month_key", "dept_id").agg(
        F.sum("amount").alias("spent"), F.count(F.lit(1)).alias("expenses"),
        F.count("amount").alias("amounts"),
    )
    by_name = (
        by_id.join(departments.select("dept_id", "dept_name"), "dept_id")
        .groupBy("budget_month_key", "dept_name")
        .agg(
            F.sum("spent").alias("monthly_expenses"),
            F.sum("expenses").alias("transaction_count"),
            F.try_divide(F.sum("spent").cast("double"), F.sum("amounts")).alias("avg_transaction_amount"),
        )
    )
    months = Window.partitionBy("dept_name").orderBy("budget_month_key")
    change = F.col("monthly_expenses") - F.col("prev_month_expenses")
    return (
        by_name.withColumn("prev_month_expenses", F.lag("monthly_expenses").over(months))
        .withColumn("month_over_month_change", guarded_pct(change, F.col("prev_month_expenses")))
        .orderBy("dept_name", "budget_month_key")
    )


def employee_expense_analysis(
    fact: DataFrame, employees: DataFrame, departments: DataFrame, vendors: DataFrame, calendar: DataFrame,
) -> DataFrame:
    """Spending profile per employee and department of the expense, over fully known expenses."""
    days = calendar.select("date", (F.col("is_weekend") | F.col("is_holiday")).alias("is_off_day"))
    by_vendor = (
        fact.join(days, F.col("trx_date") == F.col("date"))
        .groupBy("employee_id", "dept_id", "vendor_id")
        .agg(
            F.count("invoice_id").alias("invoices"),
            F.sum("amount").alias("spent"),
            F.count("amount").alias("amounts"),
            F.max("amount").alias("largest"),
            F.min("trx_date").alias("first_day"),
            F.max("trx_date").alias("last_day"),
            F.count_if("is_off_day").alias("off_day_expenses"),
            F.count_if(F.col("amount") % 100 == 0).alias("round_expenses"),
        )
    )
    return (
        by_vendor.join(vendors.select("vendor_id"), "vendor_id")
        .join(employees.select("employee_id", "employee_name"), "employee_id")
        .join(departments.select("dept_id", "dept_name"), "dept_id")
        .groupBy("employee_name", "employee_id", "dept_name")
        .agg(
            F.sum("invoices").alias("expense_count"),
            F.sum("spent").alias("total_expenses"),
            F.try_divide(F.sum("spent").cast("double"), F.sum("amounts")).alias("avg_expense_amount"),
            F.max("largest").alias("max_expense_amount"),
            F.min("first_day").alias("first_expense_date"),
            F.max("last_day").alias("last_expense_date"),
            F.count_distinct("vendor_id").alias("unique_vendors"),
            F.sum("off_day_expenses").alias("weekend_holiday_expenses"),
            F.sum("round_expenses").alias("round_number_expenses"),
        )
        .orderBy(F.col("total_expenses").desc(), "employee_id", "dept_name")
    )


def risk_dashboard(
    budgets: DataFrame, fact: DataFrame, departments: DataFrame, vendors: DataFrame, signals: DataFrame,
    as_of: Column | None = None, limits: Thresholds = DEFAULTS,
) -> DataFrame:
    """High, normal and low counts of the budget, vendor and signal views."""

    def counts(df: DataFrame, metric: str, high: Column, normal: Column, low: Column) -> DataFrame:
        return df.agg(
            F.count_if(high).alias("high_risk_count"),
            F.count_if(normal).alias("normal_count"),
            F.count_if(low).alias("low_risk_count"),
        ).select(F.lit(metric).alias("metric_type"), "*")

    pct = F.col("variance_percentage")
    risk, level = F.col("concentration_risk"), F.col("risk_level")
    flags = recent_signals(signals, as_of).select(risk_level(F.col("score")).alias("risk_level"))
    return reduce(DataFrame.unionByName, [
        counts(
            budget_vs_actual(budgets, fact, departments, limits), "Budget Variance",
            pct > limits.over_budget_pct, pct.between(limits.under_budget_pct, limits.over_budget_pct),
            pct < limits.under_budget_pct,
        ),
        counts(
            vendor_shares(fact, vendors, limits), "Vendor Concentration",
            risk == "High Risk", risk == "Medium Risk", risk.isin("Low Risk", "Minimal Risk"),
        ),
        counts(
            flags, "Leakage Signals",
            level.isin("Critical", "High"), level == "Medium", level == "Low",
        ),
    ])


def register_views(spark: SparkSession, gold: dict[str, DataFrame], as_of: Column | None = None) -> list[str]:
    """Create the seven temp views over the published tables (keys as in the table contracts, and ``vendor_rank``).

    Nothing runs until a view is read.
    """
    fact, signals, budgets = gold["fact_expense"], gold["fact_leakage_signal"], gold["fact_budget"]
    vendors, departments = gold["dim_vendor"], gold["dim_department"]
    employees, calendar = gold["dim_employee"], gold["dim_calendar"]
    views = {
        "vw_budget_vs_actual": budget_vs_actual(budgets, fact, departments),
        "vw_vendor_concentration": vendor_concentration(gold["vendor_rank"]),
        "vw_leakage_flags": leakage_flags(signals, as_of),
        "vw_campaign_roi": campaign_roi(gold["fact_campaign_spend"], gold["dim_campaign"]),
        "vw_monthly_expense_trends": monthly_expense_trends(fact, departments),
        "vw_employee_expense_analysis": employee_expense_analysis(
            fact, employees, departments, vendors, calendar
        ),
        "vw_risk_dashboard": risk_dashboard(budgets, fact, departments, vendors, signals, as_of),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return list(views)
