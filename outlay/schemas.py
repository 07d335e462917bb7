"""Declared schemas of the raw inputs and of the signal table."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, order and types of the input files.
EXPENSES = T.StructType([
    T.StructField("invoice_id", T.StringType()),
    T.StructField("vendor_id", T.IntegerType()),
    T.StructField("vendor_name", T.StringType()),
    T.StructField("employee_id", T.IntegerType()),
    T.StructField("employee_name", T.StringType()),
    T.StructField("dept_id", T.IntegerType()),
    T.StructField("dept_name", T.StringType()),
    T.StructField("trx_date", T.DateType()),
    T.StructField("amount", T.DecimalType(10, 2)),
    T.StructField("currency", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("description", T.StringType()),
])

BUDGETS = T.StructType([
    T.StructField("dept_id", T.IntegerType()),
    T.StructField("dept_name", T.StringType()),
    T.StructField("budget_month", T.StringType()),
    T.StructField("budget_amount", T.DecimalType(12, 2)),
    T.StructField("currency", T.StringType()),
])

CAMPAIGN_SPEND = T.StructType([
    T.StructField("spend_id", T.StringType()),
    T.StructField("campaign_id", T.IntegerType()),
    T.StructField("campaign_name", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("objective", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("cost", T.DecimalType(10, 2)),
    T.StructField("clicks", T.IntegerType()),
    T.StructField("impressions", T.IntegerType()),
    T.StructField("conversions", T.IntegerType()),
    T.StructField("attributed_revenue", T.DecimalType(10, 2)),
])

CALENDAR = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("week", T.IntegerType()),
    T.StructField("month_key", T.StringType()),
    T.StructField("quarter", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("is_weekend", T.BooleanType()),
    T.StructField("is_holiday", T.BooleanType()),
])

SIGNAL_COLUMNS = (
    "rule_name", "entity_type", "entity_id", "entity_name",
    "signal_date", "score", "details",
)

# The budget rows used when no budget table can be read.
FALLBACK_BUDGETS = (
    (1, "Engineering", "2024-01", 150000),
    (2, "Marketing", "2024-01", 120000),
    (3, "Sales", "2024-01", 100000),
    (4, "Finance", "2024-01", 80000),
    (5, "HR", "2024-01", 60000),
    (6, "Operations", "2024-01", 90000),
    (7, "Legal", "2024-01", 70000),
)

# The holidays of the sample year.
HOLIDAYS_2024 = (
    "2024-01-01", "2024-01-15", "2024-02-19", "2024-05-27", "2024-07-04",
    "2024-09-02", "2024-10-14", "2024-11-11", "2024-11-28", "2024-12-25",
)
