"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_match(*cases: tuple[Column, object], default: object) -> Column:
    """CASE chain: the value of the first predicate that holds, else ``default``."""
    (predicate, value), *rest = cases
    chain = F.when(predicate, value)
    for predicate, value in rest:
        chain = chain.when(predicate, value)
    return chain.otherwise(default)


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double, 0 unless the denominator is positive."""
    ratio = numerator.cast("double") / denominator.cast("double")
    return F.when(denominator > 0, ratio).otherwise(F.lit(0.0))


def guarded_pct(numerator: Column, denominator: Column) -> Column:
    return guarded_ratio(numerator, denominator) * 100


def numeric_or_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Coerce text columns to double; values that are no number become NULL."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})
