"""Data-quality checks: all checks of a table in one pass, one result row per check."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = (
    "table_name", "check_name", "column_name", "check_type", "passed",
    "failed_rows", "failed_pct", "min_value", "max_value", "message",
)


@dataclass(frozen=True)
class Check:
    name: str
    type: str
    columns: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None

    @property
    def column(self) -> str:
        return ",".join(self.columns)


def not_null(column: str) -> Check:
    return Check(f"{column}_not_null", "not_null", (column,))


def unique(*columns: str, name: str | None = None) -> Check:
    """No two rows share the columns' values; NULL counts as one value."""
    return Check(name or "_".join(columns) + "_unique", "unique", columns)


def in_range(column: str, low: float, high: float) -> Check:
    return Check(f"{column}_range", "range", (column,), low, high)


def positive(column: str) -> Check:
    return Check(f"{column}_positive", "positive", (column,))


def min_rows(rows: int) -> Check:
    return Check("min_rows", "row_count", (), rows)


# The check suites and their bounds.
EXPENSE_CHECKS = (
    not_null("invoice_id"), unique("invoice_id"), positive("amount"),
    in_range("amount", 0.01, 1_000_000.0), not_null("trx_date"), not_null("vendor_id"),
    not_null("employee_id"), not_null("dept_id"), min_rows(1),
)
# "dept_month_unique" tests the department alone, so any budget of several months fails it;
# the last check is the one on both columns.
BUDGET_CHECKS = (
    not_null("dept_id"), not_null("budget_month"), positive("budget_amount"),
    unique("dept_id", name="dept_month_unique"), min_rows(1),
    unique("dept_id", "budget_month"),
)
CAMPAIGN_CHECKS = (
    not_null("spend_id"), unique("spend_id"), positive("cost"), not_null("date"),
    not_null("campaign_id"), min_rows(1),
)


def _measure(check: Check) -> Column:
    """Failing rows of the check; for uniqueness the number of distinct values."""
    if check.type == "unique":
        # A struct is never NULL itself, so NULL values count as a value.
        return F.count_distinct(F.struct(*check.columns))
    if check.type == "row_count":
        return F.count(F.lit(1))
    column = F.col(check.columns[0])
    if check.type == "not_null":
        return F.count_if(column.isNull())
    if check.type == "positive":
        return F.count_if(column <= 0)
    return F.count_if((column < check.low) | (column > check.high))


def _result(table: str, check: Check, measured: Column, rows: Column) -> Column:
    place = f"{table}.{check.column}"
    failed = rows - measured if check.type == "unique" else measured
    pct = F.when(rows > 0, failed / rows * 100).otherwise(F.lit(0.0))
    if check.type == "row_count":
        passed = rows >= int(check.low)
        failed, pct = F.lit(None).cast("bigint"), F.lit(None).cast("double")
        message = F.format_string(f"{table}: %d rows (minimum: {int(check.low)})", rows)
    else:
        passed = failed == 0
        if check.type == "not_null":
            message = F.format_string(f"{place}: %d nulls (%.2f%%)", failed, pct)
        elif check.type == "unique":
            message = F.format_string(f"{place}: %d duplicates", failed)
        elif check.type == "positive":
            message = F.format_string(f"{place}: %d non-positive values", failed)
        else:
            message = F.format_string(
                f"{place}: %d values outside range [{check.low}, {check.high}]", failed
            )
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.type).alias("check_type"),
        passed.alias("passed"),
        failed.cast("bigint").alias("failed_rows"),
        pct.cast("double").alias("failed_pct"),
        F.lit(check.low).cast("double").alias("min_value"),
        F.lit(check.high).cast("double").alias("max_value"),
        message.alias("message"),
    )


def _distinct(df: DataFrame, check: Check) -> Column:
    """The number of distinct values, read from the check's columns alone and combined in the tasks first. NULL counts as a value."""
    values = df.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("rows"))
    return values.agg(F.count("rows")).scalar()


def run_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """One row for each check, from one aggregate over the table.

    One count of distinct values joins that aggregate. Of several, each would copy every row once more, so they are counted by themselves.
    """
    several = sum(check.type == "unique" for check in checks) > 1

    def alone(check: Check) -> bool:
        return several and check.type == "unique"

    measured = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[_measure(check).alias(f"m{i}") for i, check in enumerate(checks) if not alone(check)],
    )
    measured = measured.select("*", *[_distinct(df, check).alias(f"m{i}") for i, check in enumerate(checks) if alone(check)])
    results = [_result(table, c, F.col(f"m{i}"), F.col("rows")) for i, c in enumerate(checks)]
    return measured.select(F.inline(F.array(*results)))


def check_expenses(df: DataFrame, table: str = "expenses") -> DataFrame:
    return run_checks(df, table, EXPENSE_CHECKS)


def check_budgets(df: DataFrame, table: str = "budgets") -> DataFrame:
    return run_checks(df, table, BUDGET_CHECKS)


def check_campaign_spend(df: DataFrame, table: str = "campaign_spend") -> DataFrame:
    return run_checks(df, table, CAMPAIGN_CHECKS)


def summarize(results: DataFrame) -> DataFrame:
    """One row: total_checks, passed, failed, pass_rate."""
    total, passed = F.count(F.lit(1)), F.count_if(F.col("passed"))
    return results.agg(
        total.alias("total_checks"),
        passed.alias("passed"),
        (total - passed).alias("failed"),
        F.when(total > 0, passed / total * 100).otherwise(F.lit(0.0)).alias("pass_rate"),
    )


def exit_code(results: DataFrame) -> int:
    """0 if every check passed, else 1."""
    return 1 if results.filter(~F.col("passed")).limit(1).count() else 0
