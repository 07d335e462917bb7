"""Calendar rows for spans of days."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def day_span(df: DataFrame, day: str) -> DataFrame:
    """One row (first_day, last_day) that covers ``day``; reads only that column."""
    return df.agg(
        F.min(F.col(day).cast("date")).alias("first_day"),
        F.max(F.col(day).cast("date")).alias("last_day"),
    )


def calendar_days(
    spans: DataFrame, holidays: Iterable[str] = (), yearly_holidays: Iterable[str] = (),
) -> DataFrame:
    """One calendar row per day of each (first_day, last_day) span.

    ``holidays`` lists dates (yyyy-MM-dd), ``yearly_holidays`` days that recur (MM-dd).
    """
    one_off = [h for h in holidays]
    yearly = [h for h in yearly_holidays]
    date = F.col("date")
    holiday = F.lit(False)
    if one_off:
        holiday = holiday | date.cast("string").isin(one_off)
    if yearly:
        holiday = holiday | F.date_format(date, "MM-dd").isin(yearly)
    days = spans.filter(F.col("first_day").isNotNull()).select(
        F.explode(F.sequence("first_day", "last_day")).alias("date")
    )
    return days.select(
        date,
        F.weekofyear(date).alias("week"),
        F.date_format(date, "yyyy-MM").alias("month_key"),
        F.concat(F.lit("Q"), F.quarter(date)).alias("quarter"),
        F.year(date).alias("year"),
        (F.weekday(date) >= 5).alias("is_weekend"),
        holiday.alias("is_holiday"),
    )


def calendar_between(
    spark: SparkSession, first_day: str, last_day: str,
    holidays: Iterable[str] = (), yearly_holidays: Iterable[str] = (),
) -> DataFrame:
    """Calendar between two literal dates, both included."""
    span = spark.range(1).select(
        F.lit(first_day).cast("date").alias("first_day"),
        F.lit(last_day).cast("date").alias("last_day"),
    )
    return calendar_days(span, holidays, yearly_holidays)
