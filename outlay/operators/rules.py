"""Detection rules. Each returns signals in one common schema.

Columns: rule_name, entity_type, entity_id (string), entity_name, signal_date, score, details.
A rule whose signals depend on an entity and a day alone can give them ``counted``: one row of those, with the number of signals in ``copies``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.functions import centred_day_counts, first_match, previous_values, repeat_rows
from outlay.operators.near_duplicates import near_duplicate_points
from outlay.params import DEFAULTS, Thresholds
from outlay.schemas import SIGNAL_COLUMNS

# Rule names, entity types and scores.
DUPLICATE = "duplicate_invoice"
NEAR_DUPLICATE = "duplicate_invoice_amount"
SUB_THRESHOLD = "sub_threshold_repeats"
WEEKEND_HOLIDAY = "weekend_holiday_claim"
ROUND_NUMBER = "round_number_spikes"
CAMPAIGN_SPIKE = "campaign_spend_spike"

DUPLICATE_SCORE = 75.0
MANY_DUPLICATES_SCORE = 90.0
SUB_THRESHOLD_SCORE = 85.0
WEEKEND_AND_HOLIDAY_SCORE = 90.0
WEEKEND_SCORE = 70.0
HOLIDAY_SCORE = 60.0
ROUND_HIGH_SCORE = 65.0
ROUND_SCORE = 45.0
SPIKE_HIGH_SCORE = 80.0
SPIKE_SCORE = 60.0

COPIES = "copies"

# What the spike rule compares: the entity, the order of its rows, and the values of a row and of the one before.
STEP_VALUES = ("cost", "conversions")
STEP_COLUMNS = ("campaign_id", "date", "spend_id", *STEP_VALUES)


def _signals(
    df: DataFrame, rule: str, entity_type: str, entity_id: str, name: str, day: Column, score: Column,
    details: Column, *extra: str,
) -> DataFrame:
    return df.select(
        F.lit(rule).alias("rule_name"),
        F.lit(entity_type).alias("entity_type"),
        F.col(entity_id).cast("string").alias("entity_id"),
        F.col(name).alias("entity_name"),
        day.alias("signal_date"),
        score.cast("double").alias("score"),
        details.alias("details"),
        *extra,
    )


def _named(df: DataFrame, dimension: DataFrame, entity_id: str, name: str) -> DataFrame:
    return df.join(dimension.select(entity_id, name), entity_id, "left")


def _one_per_expense(signals: DataFrame, counted: bool) -> DataFrame:
    """A signal row describes a (entity, day); emit it once per expense of that day, or with their number."""
    if counted:
        return signals.withColumnRenamed("rows_on_day", COPIES)
    return repeat_rows(signals, "rows_on_day", "entity_id", "signal_date")


def duplicate_invoices(
    fact: DataFrame, vendors: DataFrame, limits: Thresholds = DEFAULTS, counted: bool = False,
) -> DataFrame:
    """Expenses whose vendor has another expense within the window, whatever its amount."""
    per_day = centred_day_counts(fact, "vendor_id", "trx_date", limits.duplicate_window_days, "in_window")
    flagged = _named(per_day.filter(F.col("in_window") > 1), vendors, "vendor_id", "vendor_name")
    text = F.concat(
        F.lit("Duplicate invoice detected for vendor "), "vendor_name", F.lit(f" within {limits.duplicate_window_days} days")
    )
    return _one_per_expense(_signals(
        flagged, DUPLICATE, "vendor", "vendor_id", "vendor_name", F.col("trx_date"),
        F.lit(DUPLICATE_SCORE), text, "rows_on_day",
    ), counted)


def near_duplicate_invoices(fact: DataFrame, vendors: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Expenses with another one of the same vendor, near in date and within the amount tolerance."""
    points = near_duplicate_points(
        fact, limits.duplicate_window_days, limits.duplicate_tolerance_pct
    )
    flagged = _named(points.filter(F.col("matches") >= 1), vendors, "vendor_id", "vendor_name")
    score = first_match((F.col("matches") >= 2, MANY_DUPLICATES_SCORE), default=DUPLICATE_SCORE)
    text = F.concat(
        F.lit("Invoice of similar amount for vendor "), "vendor_name",
        F.lit(f" within {limits.duplicate_window_days} days"),
    )
    signals = _signals(
        flagged, NEAR_DUPLICATE, "vendor", "vendor_id", "vendor_name", F.col("trx_date"), score, text,
        "rows_at_point", "amount",
    )
    return repeat_rows(signals, "rows_at_point", "entity_id", "signal_date", "amount").drop("amount")


def sub_threshold_repeats(
    fact: DataFrame, employees: DataFrame, limits: Thresholds = DEFAULTS, counted: bool = False,
) -> DataFrame:
    """Small claims of an employee that has at least the minimum count of them in the window."""
    small = fact.filter(F.col("amount") < limits.sub_threshold_amount)
    per_day = centred_day_counts(
        small, "employee_id", "trx_date", limits.sub_threshold_window_days, "small_claims"
    )
    repeated = per_day.filter(F.col("small_claims") >= limits.sub_threshold_min_count)
    flagged = _named(repeated, employees, "employee_id", "employee_name")
    text = F.concat(
        F.lit("Employee "), "employee_name", F.lit(" made "), "small_claims",
        F.lit(f" small claims in {limits.sub_threshold_window_days} days"),
    )
    return _one_per_expense(_signals(
        flagged, SUB_THRESHOLD, "employee", "employee_id", "employee_name", F.col("trx_date"),
        F.lit(SUB_THRESHOLD_SCORE), text, "rows_on_day",
    ), counted)


def weekend_holiday_claims(fact: DataFrame, calendar: DataFrame, employees: DataFrame, counted: bool = False) -> DataFrame:
    """Expenses dated on a weekend or a holiday; a day outside the calendar gives no signal."""
    off_days = calendar.select("date", "is_weekend", "is_holiday").filter(
        F.col("is_weekend") | F.col("is_holiday")
    )
    claims = fact.select("employee_id", "trx_date").join(off_days, F.col("trx_date") == F.col("date"))
    if counted:
        claims = claims.groupBy("employee_id", "trx_date", "is_weekend", "is_holiday").agg(F.count(F.lit(1)).alias(COPIES))
    claims = _named(claims, employees, "employee_id", "employee_name")
    both = F.col("is_weekend") & F.col("is_holiday")
    score = first_match(
        (both, WEEKEND_AND_HOLIDAY_SCORE), (F.col("is_weekend"), WEEKEND_SCORE), default=HOLIDAY_SCORE
    )
    kind = first_match((both, "weekend holiday"), (F.col("is_weekend"), "weekend"), default="holiday")
    text = F.concat(F.lit("Expense on "), kind, F.lit(" by "), "employee_name")
    return _signals(
        claims, WEEKEND_HOLIDAY, "employee", "employee_id", "employee_name", F.col("trx_date"), score, text,
        *([COPIES] if counted else []),
    )


def round_number_spikes(
    fact: DataFrame, departments: DataFrame, limits: Thresholds = DEFAULTS, as_of: Column | None = None,
) -> DataFrame:
    """Department months with an unusual share of amounts divisible by 100, dated ``as_of``."""
    is_round = F.when(F.col("amount") % 100 == 0, 1).otherwise(0)
    share = (
        fact.groupBy("dept_id", "budget_month_key")
        .agg((F.sum(is_round) / F.count(F.lit(1)) * 100).alias("round_pct"))
        .filter(F.col("round_pct") > limits.round_number_pct)
    )
    flagged = _named(share, departments, "dept_id", "dept_name")
    score = first_match(
        (F.col("round_pct") > limits.round_number_pct * 1.5, ROUND_HIGH_SCORE), default=ROUND_SCORE
    )
    text = F.concat(
        F.lit("Department "), "dept_name", F.lit(" has "), F.round("round_pct", 1),
        F.lit("% round number expenses in "), "budget_month_key",
    )
    return _signals(
        flagged, ROUND_NUMBER, "department", "dept_id", "dept_name",
        F.current_date() if as_of is None else as_of, score, text,
    )


def campaign_spend_spikes(fact: DataFrame, campaigns: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Campaign spend that jumps against the previous row while conversions do not follow."""
    compared = previous_values(fact.select(*STEP_COLUMNS), *STEP_COLUMNS[:3], list(STEP_VALUES))
    return spikes_between(compared, campaigns, limits)


def spikes_between(compared: DataFrame, campaigns: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """``campaign_spend_spikes`` of rows that carry the values of the row before, as ``sources.steps`` reads them."""

    def change(value: str) -> Column:
        before = F.col(f"prev_{value}")
        return F.when(before > 0, (F.col(value) - before) / before * 100).otherwise(0)

    changed = compared.withColumns({"cost_pct": change("cost"), "conversion_pct": change("conversions")})
    score = first_match(
        (
            (F.col("cost_pct") >= limits.spike_cost_pct * 1.5)
            & (F.col("conversion_pct") <= limits.spike_conversion_pct * 2),
            SPIKE_HIGH_SCORE,
        ),
        (
            (F.col("cost_pct") >= limits.spike_cost_pct)
            & (F.col("conversion_pct") <= limits.spike_conversion_pct),
            SPIKE_SCORE,
        ),
        default=0.0,
    )
    spikes = changed.withColumn("spike_score", score).filter(F.col("spike_score") > 0)
    flagged = _named(spikes, campaigns, "campaign_id", "campaign_name")
    text = F.concat(
        F.lit("Campaign "), "campaign_name", F.lit(" spend increased "), F.round("cost_pct", 1),
        F.lit("% with only "), F.round("conversion_pct", 1), F.lit("% conversion lift"),
    )
    return _signals(
        flagged, CAMPAIGN_SPIKE, "campaign", "campaign_id", "campaign_name", F.col("date"),
        F.col("spike_score"), text,
    )


def leakage_signals(*signal_sets: DataFrame) -> DataFrame:
    """All signals, stamped; ``signal_id`` is added when the table is written. With one counted set all are: ``copies`` tells how often to write a row."""
    if any(COPIES in s.columns for s in signal_sets):
        sets = [s if COPIES in s.columns else s.withColumn(COPIES, F.lit(1).cast("bigint")) for s in signal_sets]
        united = reduce(DataFrame.unionByName, [s.select(*SIGNAL_COLUMNS, COPIES) for s in sets])
    else:
        united = reduce(DataFrame.unionByName, [s.select(*SIGNAL_COLUMNS) for s in signal_sets])
    return united.withColumn("created_timestamp", F.current_timestamp())
