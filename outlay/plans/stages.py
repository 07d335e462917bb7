"""Batch stages. Each writes its tables and returns the row counts it wrote.

Stages hand over through Parquet tables, so a stage can be repeated alone and a lost executor
costs at most the tasks of the running write.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from outlay.functions import KeyRuns, key_side, small_side
from outlay.operators import cleaning, dimensions, facts, kpis, metrics, quality, rules, summaries, views
from outlay.params import DEFAULTS, Thresholds
from outlay.sources import contracts
from outlay.sources.commits import Files, publish
from outlay.sources.ranked import write_ranked
from outlay.sources.readers import MALFORMED, load_budgets, read_csv_text, read_table, tasks_of_rows
from outlay.sources.steps import read_steps, write_steps
from outlay.sources.writers import write_json, write_table


# Signals are looked up by day; the entity splits a day that holds much of the table.
SIGNAL_ORDER = ("signal_date", "entity_id", "rule_name")

# Accepted rows are combined by a sort in the tasks that read them and by one after their exchange: about so many at once, some 300 bytes each.
ROWS_PER_SORT = 1 << 20


def _published(spark: SparkSession, gold_dir: str, counts: dict[str, int]) -> dict[str, int]:
    """Give the tables that a stage has written their next versions, so that loads replace the earlier ones."""
    for table, rows in counts.items():
        publish(spark, gold_dir, table, rows)
    return counts


def clean_files(
    spark: SparkSession, raw_dir: str, clean_dir: str,
    expenses_file: str = "expenses_small.csv", budgets_file: str = "budgets_small.csv",
    campaign_file: str = "campaign_spend_small.csv", calendar_file: str = "holidays.csv",
) -> dict[str, int]:
    """Raw CSV files to the clean tables expenses, budgets, campaign_spend and holidays.

    ``rejects`` counts the rejected rows by reason, ``quarantine`` has the lines of rejected and repaired rows, and ``intake`` tells what
    has become of all rows of each file.
    """
    jobs = {
        "expenses": (cleaning.clean_expenses, cleaning.EXPENSES, expenses_file),
        "budgets": (cleaning.clean_budgets, cleaning.BUDGETS, budgets_file),
        "campaign_spend": (cleaning.clean_campaign_spend, cleaning.CAMPAIGN_SPEND, campaign_file),
        "holidays": (cleaning.clean_calendar, cleaning.CALENDAR, calendar_file),
    }
    counts, aside = {}, []
    for table, (clean, rules, file) in jobs.items():
        counts[table], remarkable = clean_csv(spark, f"{raw_dir}/{file}", f"{clean_dir}/{table}", rules, clean, table, file)
        aside.append(remarkable)
    set_aside = reduce(DataFrame.unionByName, aside)
    counts["quarantine"] = write_table(set_aside.filter("raw_line IS NOT NULL").drop("row_count"), f"{clean_dir}/quarantine")
    counts["intake"] = write_table(
        set_aside.groupBy("table_name", "status", "reason").agg(F.sum("row_count").alias("row_count")), f"{clean_dir}/intake")
    rejected = read_table(spark, f"{clean_dir}/intake").filter("status = 'rejected'")
    counts["rejects"] = write_table(rejected.select("table_name", "reason", "row_count"), f"{clean_dir}/rejects")
    for table in jobs:
        Files(spark, clean_dir).delete(f"_judged/{table}")
    return counts


def clean_csv(
    spark: SparkSession, path: str, clean_path: str, rules: cleaning.Rules, clean: Callable[..., DataFrame], table: str, source_file: str,
) -> tuple[int, DataFrame]:
    """One raw file to one clean table: its rows, and what was set aside.

    The file is read once. Its rows are written by their status, beside the clean tables in ``_judged``; the accepted ones go on from there. The second
    result has a row for each rejected or repaired line, and one for the clean rows and one for the duplicates among the accepted.
    """
    folder, name = clean_path.rsplit("/", 1)
    kept = f"{folder}/_judged/{name}"
    sorted_out = cleaning.judged(read_csv_text(spark, path, rules.schema), rules, MALFORMED)
    seen = Observation()
    sorted_out.observe(seen, F.count_if(F.col("status") != "rejected").alias("accepted")).write.mode("overwrite").partitionBy("status").parquet(kept)
    written = spark.read.schema(sorted_out.schema).parquet(kept)
    accepted = written.filter("status <> 'rejected'").select(*rules.schema.names)
    with tasks_of_rows(spark, seen.get["accepted"], ROWS_PER_SORT):
        rows = write_table(clean(accepted, source_file), clean_path)
    lines = written.filter("status <> 'clean'").select(
        F.lit(table).alias("table_name"), "status", "reason", "unparsed", "raw_line", F.lit(1).cast("bigint").alias("row_count"))
    counted = spark.createDataFrame(
        [(table, "clean", None, None, None, rows), (table, "duplicate", None, None, None, seen.get["accepted"] - rows)], lines.schema)
    return rows, lines.unionByName(counted)


def build_star(spark: SparkSession, clean_dir: str, gold_dir: str) -> dict[str, int]:
    """Clean tables to dimensions and facts.

    The dimensions are written first and read back, so the keys in the facts are the written
    keys and each dimension's size is known when its join is chosen. Keys come from dictionaries below ``_keys``: an id keeps
    its key in later runs, whatever ids come up in between.
    """
    expenses = read_table(spark, f"{clean_dir}/expenses")
    campaign_spend = read_table(spark, f"{clean_dir}/campaign_spend")

    def settled(name: str) -> dimensions.Settle:
        def settle(members: DataFrame) -> DataFrame:
            path = f"{gold_dir}/_members/{name}"
            write_table(members, path)
            return read_table(spark, path)

        return settle

    def lasting(dimension: str) -> dimensions.Number:
        return contracts.key_book(spark, gold_dir, dimension).numbered

    built = {
        "dim_vendor": dimensions.dim_vendor(expenses, settled("vendor"), lasting("dim_vendor")),
        "dim_employee": dimensions.dim_employee(expenses, settled("employee"), lasting("dim_employee")),
        "dim_department": dimensions.dim_department(expenses, settled("department"), lasting("dim_department")),
        "dim_campaign": dimensions.dim_campaign(campaign_spend, settled("campaign"), lasting("dim_campaign")),
        "dim_calendar": dimensions.dim_calendar(read_table(spark, f"{clean_dir}/holidays"), lasting("dim_calendar")),
    }
    counts = {name: write_table(df, f"{gold_dir}/{name}") for name, df in built.items()}

    def side(dimension: str) -> DataFrame | KeyRuns:
        def settle(runs: DataFrame) -> tuple[DataFrame, int]:
            rows = write_table(runs, f"{gold_dir}/_runs/{dimension}")
            return read_table(spark, f"{gold_dir}/_runs/{dimension}"), rows

        return key_side(read_table(spark, f"{gold_dir}/{dimension}"), counts[dimension], *contracts.NATURAL[dimension], settle)

    vendors, employees, departments = side("dim_vendor"), side("dim_employee"), side("dim_department")
    calendar = small_side(read_table(spark, f"{gold_dir}/dim_calendar"), counts["dim_calendar"])
    counts["fact_expense"] = write_table(
        facts.fact_expense(expenses, vendors, employees, departments, calendar),
        f"{gold_dir}/fact_expense", partition_by="budget_month_key", row_id="expense_id",
    )
    counts["fact_campaign_spend"] = write_table(
        facts.fact_campaign_spend(campaign_spend, calendar),
        f"{gold_dir}/fact_campaign_spend", partition_by="date",
    )
    budgets = read_table(spark, f"{clean_dir}/budgets")
    counts["fact_budget"] = write_table(contracts.fact_budget(budgets), f"{gold_dir}/fact_budget")
    counts["fact_budget_rejects"] = write_table(contracts.budgets_without_month(budgets), f"{gold_dir}/fact_budget_rejects")
    return _published(spark, gold_dir, counts)


def build_summaries(spark: SparkSession, gold_dir: str) -> dict[str, int]:
    fact = read_table(spark, f"{gold_dir}/fact_expense")
    built = {
        "summary_monthly_expenses": summaries.monthly_expenses(fact),
        "summary_dept_expenses": summaries.dept_expenses(
            fact, read_table(spark, f"{gold_dir}/dim_department")
        ),
        "summary_campaign_performance": summaries.campaign_performance(
            read_table(spark, f"{gold_dir}/fact_campaign_spend")
        ),
    }
    return _published(spark, gold_dir, {name: write_table(df, f"{gold_dir}/{name}") for name, df in built.items()})


def _campaign_steps(spark: SparkSession, gold_dir: str) -> DataFrame:
    """The campaign rows with their predecessors' values, written anew from the fact."""
    fact, path = read_table(spark, f"{gold_dir}/fact_campaign_spend"), f"{gold_dir}/_steps/campaign"
    entity, *order = rules.STEP_COLUMNS[:3]
    write_steps(fact.select(*rules.STEP_COLUMNS), entity, tuple(order), list(rules.STEP_VALUES), path)
    return read_steps(spark, path, entity, list(rules.STEP_VALUES))


def signal_sets(
    spark: SparkSession, gold_dir: str, limits: Thresholds = DEFAULTS, as_of: Column | None = None,
) -> list[DataFrame]:
    """The five rules over the star schema; those that depend on an entity and a day give counted signals."""
    fact = read_table(spark, f"{gold_dir}/fact_expense")
    vendors, employees, departments, campaigns, calendar = (
        small_side(read_table(spark, f"{gold_dir}/{name}"))
        for name in ("dim_vendor", "dim_employee", "dim_department", "dim_campaign", "dim_calendar")
    )
    return [
        rules.duplicate_invoices(fact, vendors, limits, counted=True),
        rules.sub_threshold_repeats(fact, employees, limits, counted=True),
        rules.weekend_holiday_claims(fact, calendar, employees, counted=True),
        rules.round_number_spikes(fact, departments, limits, as_of),
        rules.spikes_between(_campaign_steps(spark, gold_dir), campaigns, limits),
    ]


def detect(
    spark: SparkSession, clean_dir: str, gold_dir: str, limits: Thresholds = DEFAULTS,
    as_of: Column | None = None,
) -> dict[str, int]:
    """Signals and the two KPI tables."""
    fact = read_table(spark, f"{gold_dir}/fact_expense")
    signals = rules.leakage_signals(*signal_sets(spark, gold_dir, limits, as_of))
    return _published(spark, gold_dir, {
        "fact_leakage_signal": write_table(
            signals, f"{gold_dir}/fact_leakage_signal", row_id="signal_id", cluster_by=SIGNAL_ORDER, copies=rules.COPIES
        ),
        "kpi_budget_variance": write_table(
            kpis.budget_variance(
                fact, read_table(spark, f"{gold_dir}/dim_department"),
                load_budgets(spark, f"{clean_dir}/budgets"),
            ),
            f"{gold_dir}/kpi_budget_variance",
        ),
        "kpi_vendor_concentration": write_table(
            kpis.vendor_concentration(fact, read_table(spark, f"{gold_dir}/dim_vendor"), limits),
            f"{gold_dir}/kpi_vendor_concentration",
        ),
        "vendor_rank": write_ranked(
            views.vendor_shares(fact, read_table(spark, f"{gold_dir}/dim_vendor"), limits), views.RANK_ORDER, f"{gold_dir}/vendor_rank"
        ),
    })


def report(spark: SparkSession, gold_dir: str, report_path: str, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Write the metric report as JSON rows and return it."""
    rows = metrics.metrics_report(
        read_table(spark, f"{gold_dir}/fact_expense"),
        read_table(spark, f"{gold_dir}/fact_leakage_signal"),
        read_table(spark, f"{gold_dir}/kpi_budget_variance"),
        read_table(spark, f"{gold_dir}/kpi_vendor_concentration"),
        limits,
    )
    write_json(rows, report_path)
    return spark.read.json(report_path, schema=rows.schema)


def check_quality(spark: SparkSession, clean_dir: str, gold_dir: str) -> DataFrame:
    """Results of the suites on the clean tables and on the expense fact."""
    return (
        quality.check_expenses(read_table(spark, f"{clean_dir}/expenses"), "silver.expenses")
        .unionByName(quality.check_budgets(read_table(spark, f"{clean_dir}/budgets"), "silver.budgets"))
        .unionByName(quality.check_campaign_spend(
            read_table(spark, f"{clean_dir}/campaign_spend"), "silver.campaign_spend"
        ))
        .unionByName(quality.check_expenses(
            read_table(spark, f"{gold_dir}/fact_expense"), "gold.fact_expense"
        ))
    )


def run_all(
    spark: SparkSession, raw_dir: str, clean_dir: str, gold_dir: str, limits: Thresholds = DEFAULTS,
    as_of: Column | None = None,
) -> dict[str, int]:
    """Files to signals and KPIs; returns the rows written per table."""
    return {
        **clean_files(spark, raw_dir, clean_dir),
        **build_star(spark, clean_dir, gold_dir),
        **build_summaries(spark, gold_dir),
        **detect(spark, clean_dir, gold_dir, limits, as_of),
    }
