"""Fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outlay.functions import KeyRuns, with_key


def fact_expense(
    expenses: DataFrame, vendors: DataFrame | KeyRuns, employees: DataFrame | KeyRuns, departments: DataFrame | KeyRuns,
    calendar: DataFrame,
) -> DataFrame:
    """Expenses with dimension keys; the month is the calendar's, NULL for a day outside it.

    Only ids and keys of the dimensions enter the joins. Pass a dimension through ``key_side``: a small one is broadcast, of a large
    one only the runs of its ids are, so the expenses are not exchanged; otherwise Spark picks the join.
    """
    keyed = with_key(expenses, vendors, "vendor_id", "vendor_key")
    keyed = with_key(keyed, employees, "employee_id", "employee_key")
    return (
        with_key(keyed, departments, "dept_id", "dept_key")
        .join(
            calendar.select("date", F.col("month_key").alias("budget_month_key"), "calendar_key"),
            F.col("trx_date") == F.col("date"), "left",
        )
        .select(
            "invoice_id", "vendor_id", "employee_id", "dept_id", "trx_date", "amount", "currency",
            "payment_method", "budget_month_key", "vendor_key", "employee_key", "dept_key",
            "calendar_key", F.current_timestamp().alias("created_timestamp"),
        )
    )


def fact_campaign_spend(campaign_spend: DataFrame, calendar: DataFrame) -> DataFrame:
    return campaign_spend.join(calendar.select("date", "calendar_key"), "date", "left").select(
        "spend_id", "campaign_id", "channel", "date", "cost", "clicks", "impressions", "conversions",
        "attributed_revenue", "calendar_key", F.current_timestamp().alias("created_timestamp"),
    )
