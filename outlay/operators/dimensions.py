"""Dimension tables with surrogate keys: the 1-based rank by natural id, or those of a lasting dictionary."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outlay.functions import dense_key, keep_first

# Attributes the inputs do not carry.
VENDOR_CATEGORY = "Technology"
VENDOR_COUNTRY = "US"
EMPLOYEE_TITLE = "Employee"
EMPLOYEE_LOCATION = "Remote"
OWNER_PREFIX = "Owner_"

# Writes the few distinct rows and reads them back, so that numbering them does not read the facts again.
Settle = Callable[[DataFrame], DataFrame]
# Adds the key to one row for each id: (members, id column, key column). A dictionary's ``numbered`` gives keys that last between runs.
Number = Callable[[DataFrame, str, str], DataFrame]


def _as_is(df: DataFrame) -> DataFrame:
    return df


def _members(rows: DataFrame, id_column: str) -> DataFrame:
    """One row for each id. The distinct rows come first: they shrink by hash in each task, and only they are sorted.

    They carry their count, as the optimizer drops a bare ``distinct`` below a minimum.
    """
    distinct = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_uses"))
    return keep_first(distinct, [id_column], [c for c in rows.columns if c != id_column]).drop("_uses")


def dim_vendor(expenses: DataFrame, settle: Settle = _as_is, number: Number = dense_key) -> DataFrame:
    vendors = settle(_members(expenses.select("vendor_id", "vendor_name"), "vendor_id"))
    described = vendors.withColumns({
        "category": F.lit(VENDOR_CATEGORY), "country": F.lit(VENDOR_COUNTRY),
    })
    return number(described, "vendor_id", "vendor_key")


def dim_employee(expenses: DataFrame, settle: Settle = _as_is, number: Number = dense_key) -> DataFrame:
    people = settle(_members(expenses.select("employee_id", "employee_name", "dept_id"), "employee_id"))
    described = people.withColumns({
        "title": F.lit(EMPLOYEE_TITLE), "location": F.lit(EMPLOYEE_LOCATION),
    })
    return number(described, "employee_id", "employee_key")


def dim_department(expenses: DataFrame, settle: Settle = _as_is, number: Number = dense_key) -> DataFrame:
    departments = settle(_members(expenses.select("dept_id", "dept_name"), "dept_id"))
    owned = departments.withColumn("owner", F.concat(F.lit(OWNER_PREFIX), "dept_name"))
    return number(owned, "dept_id", "dept_key")


def dim_campaign(campaign_spend: DataFrame, settle: Settle = _as_is, number: Number = dense_key) -> DataFrame:
    columns = ["campaign_id", "campaign_name", "channel", "objective"]
    return number(settle(_members(campaign_spend.select(*columns), "campaign_id")), "campaign_id", "campaign_key")


def dim_calendar(calendar: DataFrame, number: Number = dense_key) -> DataFrame:
    """``calendar`` already holds one row per date."""
    columns = ["date", "week", "month_key", "quarter", "year", "is_weekend", "is_holiday"]
    return number(calendar.select(*columns), "date", "calendar_key")
