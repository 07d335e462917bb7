"""Every operator as a named query over a test-data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outlay import schemas
from outlay.catalog.inputs import LIMITS, Tables, scratch_folder
from outlay.functions import numeric_or_null
from outlay.operators import cleaning, insights, kpis, metrics, quality, summaries, views
from outlay.plans import stages
from outlay.sources import contracts
from outlay.sources.commits import publish
from outlay.sources.readers import load_budgets, read_csv, read_csv_inferred, read_table
from outlay.sources.writers import write_csv, write_json, write_table

Query = Callable[[SparkSession, str], DataFrame]

# Columns whose values depend on the clock or on physical row order.
UNSTABLE = ("ingestion_timestamp", "created_timestamp", "updated_timestamp", "expense_id", "budget_id", "signal_id")


def comparable(df: DataFrame, digits: int | None = 6) -> DataFrame:
    """``df`` without unstable columns, with bigint, double (rounded), text, date and boolean only."""

    def column(field: T.StructField):
        value = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = value if digits is None else F.round(value.cast("double"), digits)
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            value = value.cast("bigint")
        return value.alias(field.name)

    return df.select(*[column(f) for f in df.schema if f.name not in UNSTABLE])


def _scratch(t: Tables, name: str) -> str:
    """A new place for a query that writes and reads back."""
    return f"{scratch_folder(t.spark)}/{name}"


def _csv_roundtrip(t: Tables) -> DataFrame:
    path = _scratch(t, "expenses_csv")
    write_csv(t.raw_expenses.drop("l_quantity", "l_discount"), path)
    return cleaning.clean_expenses(read_csv(t.spark, path, schemas.EXPENSES), "expenses_csv").drop("source_file")


def _csv_inferred(t: Tables) -> DataFrame:
    path = _scratch(t, "budgets_csv")
    write_csv(t.raw_budgets, path)
    return read_csv_inferred(t.spark, path).groupBy("dept_id").agg(
        F.count(F.lit(1)).alias("budget_rows"), F.round(F.sum("budget_amount"), 2).alias("budget_total"),
    )


def _partitioned_fact(t: Tables) -> DataFrame:
    path = _scratch(t, "fact_expense")
    write_table(t.fact_expense_of(), path, partition_by="budget_month_key", row_id="expense_id")
    back = read_table(t.spark, path)
    return back.filter(F.col("budget_month_key") >= "1998-01").groupBy("budget_month_key").agg(
        F.sum("amount").alias("total_expenses"),
        F.count(F.lit(1)).alias("expense_count"),
        F.count_distinct("expense_id").alias("distinct_ids"),
    )


def _partitioned_campaign(t: Tables) -> DataFrame:
    path = _scratch(t, "fact_campaign_spend")
    write_table(t.fact_campaign_spend_of(), path, partition_by="date")
    return read_table(t.spark, path).filter(F.col("date") >= F.lit("2024-01-15").cast("date")).select(
        "spend_id", "campaign_id", "date", "cost", "clicks", "impressions", "conversions", "attributed_revenue",
    )


def _json_report(t: Tables) -> DataFrame:
    path = _scratch(t, "metrics_report")
    rows = metrics.metrics_report(t.fact_expense, t.signals, t.variance, t.concentration, LIMITS)
    write_json(rows, path)
    return t.spark.read.json(path, schema=rows.schema)


def _load_contract(t: Tables) -> DataFrame:
    """The same folder loaded twice counts once."""
    folder = _scratch(t, "load")
    write_table(t.fact_expense, f"{folder}/gold/fact_expense", partition_by="budget_month_key")
    contracts.load_table(t.spark, f"{folder}/gold", f"{folder}/warehouse", "fact_expense")
    contracts.load_table(t.spark, f"{folder}/gold", f"{folder}/warehouse", "fact_expense")
    return contracts.read_loaded(t.spark, f"{folder}/warehouse", "fact_expense").groupBy("vendor_id").agg(
        F.count(F.lit(1)).alias("loaded_rows"), F.sum("amount").alias("loaded_amount"),
    )


def _load_contract_second(t: Tables) -> DataFrame:
    """Two folders: the rows of both, under keys that do not repeat."""
    folder = _scratch(t, "load")
    for part in ("first", "second"):
        write_table(t.budgets, f"{folder}/{part}/fact_budget")
        contracts.load_table(t.spark, f"{folder}/{part}", f"{folder}/warehouse", "fact_budget")
    loaded = contracts.read_loaded(t.spark, f"{folder}/warehouse", "fact_budget")
    return loaded.groupBy("dept_id").agg(
        F.count(F.lit(1)).alias("loaded_rows"), F.count_distinct("budget_id").alias("distinct_keys"),
        F.sum("budget_amount").alias("loaded_amount"),
    )


def _load_rebuilt(t: Tables) -> DataFrame:
    """Three versions of the fact, a load after each: half of the vendors, all of them, and the same rows once more."""
    folder = _scratch(t, "load")
    whole = t.fact_expense
    for version in (whole.filter(F.col("vendor_id") % 2 == 0), whole, whole.orderBy("invoice_id")):
        rows = write_table(version, f"{folder}/gold/fact_expense", partition_by="budget_month_key", row_id=None)
        publish(t.spark, f"{folder}/gold", "fact_expense", rows)
        contracts.load_table(t.spark, f"{folder}/gold", f"{folder}/warehouse", "fact_expense")
    return contracts.read_loaded(t.spark, f"{folder}/warehouse", "fact_expense").groupBy("budget_month_key").agg(
        F.count(F.lit(1)).alias("loaded_rows"), F.count_distinct("expense_id").alias("distinct_keys"),
        F.sum("amount").alias("loaded_amount"),
    )


def _lasting_keys(t: Tables) -> DataFrame:
    """Vendors of even ids first, all vendors under new names later: keys of the first load stay, the others follow."""
    folder = _scratch(t, "load")
    later = t.dim_vendor.withColumn("vendor_name", F.upper("vendor_name"))
    for version in (t.dim_vendor.filter(F.col("vendor_id") % 2 == 0), later):
        publish(t.spark, f"{folder}/gold", "dim_vendor", write_table(version, f"{folder}/gold/dim_vendor"))
        contracts.load_table(t.spark, f"{folder}/gold", f"{folder}/warehouse", "dim_vendor")
    write_table(t.fact_expense, f"{folder}/gold/fact_expense", partition_by="budget_month_key")
    contracts.load_table(t.spark, f"{folder}/gold", f"{folder}/warehouse", "fact_expense")
    dimension = contracts.read_loaded(t.spark, f"{folder}/warehouse", "dim_vendor")
    fact = contracts.read_loaded(t.spark, f"{folder}/warehouse", "fact_expense")
    spent = fact.groupBy("vendor_key").agg(F.count(F.lit(1)).alias("expense_count"))
    return dimension.join(spent, "vendor_key", "left").select("vendor_id", "vendor_key", "vendor_name", "expense_count")


def _quarantine(t: Tables) -> DataFrame:
    """A CSV with cells that do not parse, through the cleaning stage: what became of its rows, by reason and unparsed cells."""
    folder = _scratch(t, "intake")
    quantity = F.col("l_quantity")

    def spoilt(column: str, at: int, text: str | None):
        return F.when(quantity != at, F.col(column).cast("string")).otherwise(F.lit(text))

    raw = t.raw_expenses.withColumns({
        "amount": F.when(quantity == 6, "12.5.1").otherwise(spoilt("amount", 1, "n/a")), "trx_date": spoilt("trx_date", 2, "1998-13-45"),
        "invoice_id": spoilt("invoice_id", 3, None), "vendor_id": spoilt("vendor_id", 4, "V7"), "dept_id": spoilt("dept_id", 5, "none"),
    })
    write_csv(raw.drop("l_quantity", "l_discount"), f"{folder}/raw")
    _, aside = stages.clean_csv(
        t.spark, f"{folder}/raw", f"{folder}/clean/expenses", cleaning.EXPENSES, cleaning.clean_expenses, "expenses", "expenses_csv")
    return aside.groupBy("status", "reason", F.array_join("unparsed", ",").alias("unparsed")).agg(
        F.sum("row_count").alias("row_count"), F.count_if(F.col("raw_line").like("INV-%") | F.col("raw_line").like(",%")).alias("kept_lines"))


def _fallback_variance(t: Tables) -> DataFrame:
    """All spending taken as of the month that the fallback budgets are for."""
    budgets = load_budgets(t.spark, _scratch(t, "no_such_table"))
    fact = t.fact_expense.withColumn("budget_month_key", F.lit(schemas.FALLBACK_BUDGETS[0][2]))
    return kpis.budget_variance(fact, t.dim_department, budgets)


def _fallback_rows(t: Tables) -> DataFrame:
    """The fallback budgets with the number of expenses of their departments."""
    budgets = load_budgets(t.spark, _scratch(t, "no_such_table"))
    spent = t.fact_expense.groupBy("dept_id").agg(F.count(F.lit(1)).alias("expense_count"))
    return budgets.join(spent, "dept_id", "left").withColumn("expense_count", F.coalesce("expense_count", F.lit(0)))


def _coerced(t: Tables) -> DataFrame:
    """Text columns to numbers: half of the descriptions' rows carry a text that is no number."""
    texts = t.expenses.select(
        "dept_id",
        F.when(F.col("vendor_id") % 2 == 0, F.col("amount").cast("string")).otherwise("n/a").alias("amount_text"),
    )
    return numeric_or_null(texts, ["amount_text"]).groupBy("dept_id").agg(
        F.count("amount_text").alias("numbers"),
        F.count_if(F.col("amount_text").isNull()).alias("not_numbers"),
        F.round(F.sum(F.col("amount_text").cast("decimal(12,2)")), 2).alias("total"),
    )


def _quality_results(t: Tables) -> DataFrame:
    return (
        quality.check_expenses(t.expenses, "silver.expenses")
        .unionByName(quality.check_budgets(t.budgets, "silver.budgets"))
        .unionByName(quality.check_campaign_spend(t.campaign_spend, "silver.campaign_spend"))
        .unionByName(quality.check_expenses(t.fact_expense, "gold.fact_expense"))
    )


def _contract(
    table: str, source: Callable[[Tables], DataFrame], wide_money: bool = False,
) -> Callable[[Tables], DataFrame]:
    return lambda t: contracts.conform(source(t), table, wide_money)


BUILDERS: dict[str, Callable[[Tables], DataFrame]] = {
    "clean_expenses": lambda t: t.expenses_of(),
    "clean_expenses_flawed": lambda t: cleaning.clean_expenses(t.flawed_expenses, "lineitem"),
    "clean_budgets": lambda t: t.budgets_of(),
    "clean_rejects": lambda t: cleaning.rejects(t.flawed_expenses, cleaning.EXPENSES, "expenses"),
    "clean_campaign_spend": lambda t: t.campaign_spend_of(),
    "clean_calendar": lambda t: t.calendar_of(),
    "csv_roundtrip": _csv_roundtrip,
    "csv_inferred": _csv_inferred,
    "numeric_coercion": _coerced,
    "dim_vendor": lambda t: t.dim_vendor_of(),
    "dim_employee": lambda t: t.dim_employee_of(),
    "dim_department": lambda t: t.dim_department_of(),
    "dim_campaign": lambda t: t.dim_campaign_of(),
    "dim_calendar": lambda t: t.dim_calendar_of(),
    "fact_expense": lambda t: t.fact_expense_of(),
    "fact_campaign_spend": lambda t: t.fact_campaign_spend_of(),
    "fact_budget": lambda t: contracts.fact_budget(t.budgets),
    "partitioned_fact_scan": _partitioned_fact,
    "partitioned_campaign_scan": _partitioned_campaign,
    "summary_monthly": lambda t: summaries.monthly_expenses(t.fact_expense),
    "summary_dept": lambda t: summaries.dept_expenses(t.fact_expense, t.dim_department),
    "summary_campaign": lambda t: summaries.campaign_performance(t.fact_campaign_spend),
    "rule_duplicate": lambda t: t.duplicates_of(),
    "rule_duplicate_amount": lambda t: t.near_duplicates_of(),
    "rule_sub_threshold": lambda t: t.sub_threshold_of(),
    "rule_weekend_holiday": lambda t: t.weekend_of(),
    "rule_round_number": lambda t: t.round_number_of(),
    "rule_campaign_spike": lambda t: t.campaign_spikes_of(),
    "leakage_signals": lambda t: t.signals_of(),
    "budget_variance": lambda t: t.variance_of(),
    "budget_fallback": _fallback_variance,
    "fallback_budgets": _fallback_rows,
    "vendor_concentration": lambda t: t.concentration_of(),
    "metrics_expenses": lambda t: metrics.expense_metrics(t.fact_expense),
    "metrics_signals": lambda t: metrics.signal_metrics(metrics.signals_per_rule(t.signals)),
    "metrics_by_rule": lambda t: metrics.rule_counts(metrics.signals_per_rule(t.signals)),
    "metrics_budget": lambda t: metrics.budget_metrics(t.variance, LIMITS),
    "metrics_vendors": lambda t: metrics.vendor_metrics(t.concentration),
    "metrics_top5": lambda t: metrics.top_vendors(t.concentration),
    "leakage_estimate": lambda t: metrics.leakage_estimate(
        metrics.expense_metrics(t.fact_expense), metrics.signal_metrics(metrics.signals_per_rule(t.signals))
    ),
    "metrics_report": _json_report,
    "dq_expenses": lambda t: quality.check_expenses(t.expenses, "silver.expenses"),
    "dq_expenses_flawed": lambda t: quality.check_expenses(t.flawed_expenses, "bronze.expenses"),
    "dq_budgets": lambda t: quality.check_budgets(t.budgets, "silver.budgets"),
    "dq_campaign": lambda t: quality.check_campaign_spend(t.campaign_spend, "silver.campaign_spend"),
    "dq_fact": lambda t: quality.check_expenses(t.fact_expense, "gold.fact_expense"),
    "dq_summary": lambda t: quality.summarize(_quality_results(t)),
    "vw_budget_vs_actual": lambda t: views.budget_vs_actual(t.budgets, t.fact_expense, t.dim_department, LIMITS),
    "vw_vendor_concentration": lambda t: views.vendor_concentration(t.vendor_rank),
    "vw_leakage_flags": lambda t: views.leakage_flags(t.signals, t.as_of),
    "vw_campaign_roi": lambda t: views.campaign_roi(t.fact_campaign_spend, t.dim_campaign),
    "vw_monthly_expense_trends": lambda t: views.monthly_expense_trends(t.fact_expense, t.dim_department),
    "vw_employee_expense_analysis": lambda t: views.employee_expense_analysis(
        t.fact_expense, t.dim_employee, t.dim_department, t.dim_vendor, t.dim_calendar
    ),
    "vw_risk_dashboard": lambda t: views.risk_dashboard(
        t.budgets, t.fact_expense, t.dim_department, t.dim_vendor, t.signals, t.as_of, LIMITS
    ),
    "insight_monthly_expenses": lambda t: insights.monthly_expenses(t.fact_expense),
    "insight_monthly_expense_figures": lambda t: insights.monthly_expense_figures(t.fact_expense),
    "insight_signals_by_rule": lambda t: insights.signals_by_rule(t.signals),
    "insight_signals_by_rule_figures": lambda t: insights.signals_by_rule_figures(t.signals),
    "insight_score_histogram": lambda t: insights.score_histogram(t.signals),
    "insight_score_figures": lambda t: insights.score_figures(t.signals),
    "insight_signals_over_time": lambda t: insights.signals_over_time(t.signals),
    "insight_signals_over_time_figures": lambda t: insights.signals_over_time_figures(t.signals),
    "insight_budget_variance_figures": lambda t: insights.budget_variance_figures(t.variance, LIMITS),
    "insight_monthly_budget": lambda t: insights.monthly_budget(t.variance),
    "insight_monthly_budget_figures": lambda t: insights.monthly_budget_figures(t.variance),
    "insight_top_vendors": lambda t: insights.top_vendors(t.concentration),
    "insight_top_vendor_figures": lambda t: insights.top_vendor_figures(t.concentration),
    "insight_vendor_risk": lambda t: insights.vendor_risk_split(t.concentration),
    "insight_rule_names": lambda t: insights.rule_names(t.signals),
    "insight_signal_listing": lambda t: insights.filter_signals(t.signals, "Critical", "sub_threshold_repeats"),
    "insight_headline": lambda t: insights.headline(t.fact_expense, t.signals, t.concentration),
    "contract_dim_vendor": _contract("dim_vendor", lambda t: t.dim_vendor),
    "contract_dim_employee": _contract("dim_employee", lambda t: t.dim_employee),
    "contract_dim_department": _contract("dim_department", lambda t: t.dim_department),
    "contract_dim_campaign": _contract("dim_campaign", lambda t: t.dim_campaign),
    "contract_dim_calendar": _contract("dim_calendar", lambda t: t.dim_calendar),
    "contract_fact_expense": _contract("fact_expense", lambda t: t.fact_expense),
    "contract_fact_campaign_spend": _contract("fact_campaign_spend", lambda t: t.fact_campaign_spend),
    "contract_fact_leakage_signal": lambda t: contracts.conform(t.signals, "fact_leakage_signal"),
    "contract_summary_monthly": _contract(
        "summary_monthly_expenses", lambda t: summaries.monthly_expenses(t.fact_expense), wide_money=True
    ),
    "contract_summary_dept": _contract(
        "summary_dept_expenses", lambda t: summaries.dept_expenses(t.fact_expense, t.dim_department),
        wide_money=True,
    ),
    "contract_summary_campaign": _contract(
        "summary_campaign_performance", lambda t: summaries.campaign_performance(t.fact_campaign_spend),
        wide_money=True,
    ),
    "load_contract": _load_contract,
    "load_contract_second": _load_contract_second,
    "load_rebuilt": _load_rebuilt,
    "load_lasting_keys": _lasting_keys,
    "quarantine_rows": _quarantine,
}

# The report holds amounts of many digits; the two views hold plain quotients, left as they are.
DIGITS = {"metrics_report": 4, "vw_employee_expense_analysis": None, "vw_monthly_expense_trends": None}


def _query(name: str, build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, folder: comparable(build(Tables.shared(spark, folder)), DIGITS.get(name, 6))


def all_queries() -> dict[str, Query]:
    return {name: _query(name, build) for name, build in BUILDERS.items()}
