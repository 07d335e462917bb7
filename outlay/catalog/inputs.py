"""Spend-shaped inputs derived from the test tables, and every table built on them.

``raw_*`` are the raw inputs, with duplicate invoices, several budget versions per month,
campaigns with many rows a day, and expenses dated after the calendar's end.
"""

from __future__ import annotations

import atexit
import tempfile
from collections.abc import Callable
from functools import cached_property
from itertools import count

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outlay.functions import small_side
from outlay.operators import cleaning, dimensions, facts, kpis, rules, views
from outlay.params import Thresholds
from outlay.plans.stages import SIGNAL_ORDER
from outlay.sources.calendar import calendar_days, day_span
from outlay.sources.ranked import read_ranked, write_ranked
from outlay.sources.readers import read_table, spread_if_few_splits
from outlay.sources.steps import read_steps, write_steps
from outlay.sources.writers import write_table

# Limits that make every rule and band occur in the test tables.
LIMITS = Thresholds(
    sub_threshold_amount=20_000, vendor_high_pct=1.3, vendor_medium_pct=1.1, vendor_low_pct=0.9,
)
AS_OF = "2001-11-30"
YEARLY_HOLIDAYS = ("01-01", "07-04", "11-11", "12-25")


_STORES: dict[tuple[str, str], tuple[str, dict[str, int]]] = {}
_NUMBERS = count(1)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder: in the cluster's shared checkpoint folder, or a temporary one in local mode."""
    context = spark.sparkContext
    shared = context.getConf().get("spark.checkpoint.dir")
    if shared is None and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    path = tempfile.mkdtemp(prefix="outlay-") if shared is None else (
        f"{shared.rstrip('/')}/outlay-{context.applicationId}-{next(_NUMBERS)}"
    )
    atexit.register(_remove, context, path)
    return path


def _remove(context: SparkContext, path: str) -> None:
    """Delete a scratch folder when the application ends."""
    if context._jsc is not None and not context._jsc.sc().isStopped():
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


class Tables:
    """The inputs and tables over one test-data folder."""

    def __init__(self, spark: SparkSession, folder: str, store: str, written: dict[str, int]):
        self.spark, self.folder, self.store, self.written = spark, folder, store, written

    @classmethod
    def shared(cls, spark: SparkSession, folder: str) -> Tables:
        """Tables that reuse what this application has already written for ``folder``."""
        key = (spark.sparkContext.applicationId, folder)
        if key not in _STORES:
            _STORES[key] = (scratch_folder(spark), {})
        return cls(spark, folder, *_STORES[key])

    def stored(
        self, name: str, build: Callable[[], DataFrame], row_id: str | None = None, cluster_by: tuple[str, ...] = (),
        copies: str | None = None,
    ) -> DataFrame:
        path = f"{self.store}/{name}"
        if name not in self.written:
            self.written[name] = write_table(build(), path, row_id=row_id, cluster_by=cluster_by, copies=copies)
        return read_table(self.spark, path)

    def lookup(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A stored dimension, with a broadcast hint if it is small."""
        table = self.stored(name, build)
        return small_side(table, self.written[name])

    def members(self, name: str) -> Callable[[DataFrame], DataFrame]:
        return lambda rows: self.stored(f"{name}_members", lambda: rows)

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def as_of(self):
        return F.lit(AS_OF).cast("date")

    @property
    def raw_expenses(self) -> DataFrame:
        customer = self.source("customer").select("c_custkey", "c_nationkey")
        nation = self.source("nation").select("n_nationkey", "n_name")
        # Customers join the narrow orders: beyond the broadcast limit they would exchange all lines once more.
        orders = (
            self.source("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
            .join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        )
        supplier = self.source("supplier").select("s_suppkey", "s_name")
        employee = F.col("o_custkey") % 100
        amount = F.when(
            F.col("l_linenumber") == 1, F.round(F.col("l_extendedprice") / 100) * 100
        ).otherwise(F.col("l_extendedprice"))
        lines = self.source("lineitem").select(
            "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
            "l_returnflag", "l_linestatus", "l_shipdate",
        )
        return (
            spread_if_few_splits(lines, "l_orderkey", "l_linenumber")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
            .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
            .select(
                F.concat(F.lit("INV-"), "l_orderkey", F.lit("-"), "l_linenumber").alias("invoice_id"),
                F.col("l_suppkey").cast("int").alias("vendor_id"),
                F.col("s_name").alias("vendor_name"),
                employee.cast("int").alias("employee_id"),
                F.concat(F.lit("Employee "), employee).alias("employee_name"),
                F.col("c_nationkey").alias("dept_id"),
                F.col("n_name").alias("dept_name"),
                F.col("l_shipdate").cast("date").alias("trx_date"),
                amount.cast("decimal(10,2)").alias("amount"),
                F.lit("USD").alias("currency"),
                F.col("o_orderpriority").alias("payment_method"),
                F.concat("l_returnflag", "l_linestatus").alias("description"),
                "l_quantity", "l_discount",
            )
        )

    @property
    def flawed_expenses(self) -> DataFrame:
        """The raw expenses with missing ids and dates, credits and amounts of millions."""
        quantity, discount = F.col("l_quantity"), F.col("l_discount")
        amount = F.when(discount == 0.1, -F.col("amount")).when(
            discount == 0.09, F.col("amount") * 50
        ).otherwise(F.col("amount"))
        return self.raw_expenses.withColumns({
            "invoice_id": F.when(quantity != 1, F.col("invoice_id")),
            "trx_date": F.when(quantity != 2, F.col("trx_date")),
            "vendor_id": F.when(quantity != 3, F.col("vendor_id")),
            "employee_id": F.when(quantity != 4, F.col("employee_id")),
            "dept_id": F.when(quantity != 5, F.col("dept_id")),
            "amount": amount.cast("decimal(10,2)"),
        })

    @property
    def raw_budgets(self) -> DataFrame:
        orders = self.source("orders")
        customer = self.source("customer").select("c_custkey", "c_nationkey")
        nation = self.source("nation").select("n_nationkey", "n_name")
        month = F.month("o_orderdate")
        largest = F.max(F.col("o_totalprice").cast("decimal(12,2)"))  # stays in range however many orders there are
        factor = (
            F.when(F.col("dept_id") % 3 == 0, F.lit("2.50")).when(F.col("dept_id") % 3 == 1, F.lit("3.25"))
            .otherwise(F.lit("4.00")).cast("decimal(3,2)")
        )
        return (
            orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .filter((F.col("c_nationkey") + month) % 7 != 0)
            .groupBy(
                F.col("c_nationkey").alias("dept_id"),
                F.date_format("o_orderdate", "yyyy-MM").alias("budget_month"), "o_orderpriority",
            )
            .agg(largest.alias("largest"))
            .join(nation, F.col("dept_id") == F.col("n_nationkey"), "left")
            .select(
                "dept_id", F.col("n_name").alias("dept_name"), "budget_month",
                F.round(F.col("largest") * factor, 2).cast("decimal(12,2)").alias("budget_amount"),
                F.lit("USD").alias("currency"),
            )
        )

    @property
    def raw_campaign_spend(self) -> DataFrame:
        campaign = (F.col("user_id") % 20).cast("int")
        day = F.col("ts").cast("date")
        value = F.col("value").cast("decimal(10,2)")
        kind = F.col("event_type")
        return (
            self.source("events")
            .groupBy("user_id", day.alias("date"))
            .agg(
                F.sum(value).cast("decimal(10,2)").alias("cost"),
                F.count_if(kind == "click").cast("int").alias("clicks"),
                F.count_if(kind == "view").cast("int").alias("impressions"),
                F.count_if(kind == "purchase").cast("int").alias("conversions"),
                F.sum(F.when(kind == "purchase", value).otherwise(0)).cast("decimal(10,2)").alias(
                    "attributed_revenue"
                ),
            )
            .select(
                F.concat(F.lit("SPEND-"), "user_id", F.lit("-"), "date").alias("spend_id"),
                campaign.alias("campaign_id"),
                F.concat(F.lit("Campaign_"), campaign).alias("campaign_name"),
                F.concat(F.lit("Channel_"), F.col("user_id") % 6).alias("channel"),
                F.concat(F.lit("Objective_"), campaign % 4).alias("objective"),
                "date", "cost", "clicks", "impressions", "conversions", "attributed_revenue",
            )
        )

    @property
    def raw_calendar(self) -> DataFrame:
        """The days of all orders and of all events."""
        spans = day_span(self.source("orders"), "o_orderdate").unionByName(
            day_span(self.source("events"), "ts")
        )
        return calendar_days(spans, yearly_holidays=YEARLY_HOLIDAYS)

    # Each layer is written once per application and folder and then read by every query, as
    # the batch stages do. ``*_of`` builds the last step alone, from the written tables below it.

    def expenses_of(self) -> DataFrame:
        return cleaning.clean_expenses(self.raw_expenses, "lineitem")

    @cached_property
    def expenses(self) -> DataFrame:
        return self.stored("expenses", self.expenses_of)

    def budgets_of(self) -> DataFrame:
        return cleaning.clean_budgets(self.raw_budgets, "orders")

    @cached_property
    def budgets(self) -> DataFrame:
        return self.stored("budgets", self.budgets_of)

    def campaign_spend_of(self) -> DataFrame:
        return cleaning.clean_campaign_spend(self.raw_campaign_spend, "events")

    @cached_property
    def campaign_spend(self) -> DataFrame:
        return self.stored("campaign_spend", self.campaign_spend_of)

    def calendar_of(self) -> DataFrame:
        return cleaning.clean_calendar(self.raw_calendar, "calendar")

    @cached_property
    def calendar(self) -> DataFrame:
        return self.stored("calendar", self.calendar_of)

    def dim_vendor_of(self) -> DataFrame:
        return dimensions.dim_vendor(self.expenses, self.members("vendor"))

    @cached_property
    def dim_vendor(self) -> DataFrame:
        return self.lookup("dim_vendor", self.dim_vendor_of)

    def dim_employee_of(self) -> DataFrame:
        return dimensions.dim_employee(self.expenses, self.members("employee"))

    @cached_property
    def dim_employee(self) -> DataFrame:
        return self.lookup("dim_employee", self.dim_employee_of)

    def dim_department_of(self) -> DataFrame:
        return dimensions.dim_department(self.expenses, self.members("department"))

    @cached_property
    def dim_department(self) -> DataFrame:
        return self.lookup("dim_department", self.dim_department_of)

    def dim_campaign_of(self) -> DataFrame:
        return dimensions.dim_campaign(self.campaign_spend, self.members("campaign"))

    @cached_property
    def dim_campaign(self) -> DataFrame:
        return self.lookup("dim_campaign", self.dim_campaign_of)

    def dim_calendar_of(self) -> DataFrame:
        return dimensions.dim_calendar(self.calendar)

    @cached_property
    def dim_calendar(self) -> DataFrame:
        return self.lookup("dim_calendar", self.dim_calendar_of)

    def fact_expense_of(self) -> DataFrame:
        return facts.fact_expense(
            self.expenses, self.dim_vendor, self.dim_employee, self.dim_department, self.dim_calendar
        )

    @cached_property
    def fact_expense(self) -> DataFrame:
        return self.stored("fact_expense", self.fact_expense_of, row_id="expense_id")

    def fact_campaign_spend_of(self) -> DataFrame:
        return facts.fact_campaign_spend(self.campaign_spend, self.dim_calendar)

    @cached_property
    def fact_campaign_spend(self) -> DataFrame:
        return self.stored("fact_campaign_spend", self.fact_campaign_spend_of)

    @cached_property
    def campaign_steps(self) -> DataFrame:
        path, values = f"{self.store}/campaign_steps", list(rules.STEP_VALUES)
        entity, *order = rules.STEP_COLUMNS[:3]
        if "campaign_steps" not in self.written:
            spend = self.fact_campaign_spend.select(*rules.STEP_COLUMNS)
            self.written["campaign_steps"] = write_steps(spend, entity, tuple(order), values, path)
        return read_steps(self.spark, path, entity, values)

    def duplicates_of(self, counted: bool = False) -> DataFrame:
        return rules.duplicate_invoices(self.fact_expense, self.dim_vendor, LIMITS, counted)

    def near_duplicates_of(self) -> DataFrame:
        return rules.near_duplicate_invoices(self.fact_expense, self.dim_vendor, LIMITS)

    def sub_threshold_of(self, counted: bool = False) -> DataFrame:
        return rules.sub_threshold_repeats(self.fact_expense, self.dim_employee, LIMITS, counted)

    def weekend_of(self, counted: bool = False) -> DataFrame:
        return rules.weekend_holiday_claims(self.fact_expense, self.dim_calendar, self.dim_employee, counted)

    def round_number_of(self) -> DataFrame:
        return rules.round_number_spikes(self.fact_expense, self.dim_department, LIMITS, self.as_of)

    def campaign_spikes_of(self) -> DataFrame:
        return rules.spikes_between(self.campaign_steps, self.dim_campaign, LIMITS)

    def signals_of(self, counted: bool = False) -> DataFrame:
        return rules.leakage_signals(
            self.duplicates_of(counted), self.sub_threshold_of(counted), self.weekend_of(counted), self.round_number_of(),
            self.campaign_spikes_of(),
        )

    @cached_property
    def signals(self) -> DataFrame:
        return self.stored("fact_leakage_signal", lambda: self.signals_of(counted=True), "signal_id", SIGNAL_ORDER, rules.COPIES)

    def variance_of(self) -> DataFrame:
        return kpis.budget_variance(self.fact_expense, self.dim_department, self.budgets)

    @cached_property
    def variance(self) -> DataFrame:
        return self.stored("kpi_budget_variance", self.variance_of)

    def concentration_of(self) -> DataFrame:
        return kpis.vendor_concentration(self.fact_expense, self.dim_vendor, LIMITS)

    @cached_property
    def vendor_rank(self) -> DataFrame:
        path = f"{self.store}/vendor_rank"
        if "vendor_rank" not in self.written:
            shares = views.vendor_shares(self.fact_expense, self.dim_vendor, LIMITS)
            self.written["vendor_rank"] = write_ranked(shares, views.RANK_ORDER, path)
        return read_ranked(self.spark, path, "vendor_rank")

    @cached_property
    def concentration(self) -> DataFrame:
        return self.stored("kpi_vendor_concentration", self.concentration_of)
