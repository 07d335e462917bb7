"""Raw inputs to clean tables: required keys, positive amounts, declared types, one row per key.

Rows that a rule rejects are counted by their first reason: in the pass that writes the clean table, if it is given an
observation, or as a table of their own by ``rejects``. ``judged`` keeps the rows themselves, with their lines, for a quarantine.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outlay import schemas
from outlay.functions import keep_first


@dataclass(frozen=True)
class Rules:
    """What a row must have: keys that are not NULL, and an amount above zero."""

    schema: T.StructType
    required: tuple[str, ...]
    positive: str | None = None


EXPENSES = Rules(schemas.EXPENSES, ("invoice_id", "trx_date"), "amount")
BUDGETS = Rules(schemas.BUDGETS, ("dept_id",), "budget_amount")
CAMPAIGN_SPEND = Rules(schemas.CAMPAIGN_SPEND, ("spend_id", "date"), "cost")
CALENDAR = Rules(schemas.CALENDAR, ("date",))


def stamp(df: DataFrame, source_file: str | None) -> DataFrame:
    """Add the ingestion time and the name of the source."""
    return df.withColumns({
        "ingestion_timestamp": F.current_timestamp(),
        "source_file": F.lit(source_file).cast("string"),
    })


def _cast(df: DataFrame, field: T.StructField) -> Column:
    same = df.schema[field.name].dataType == field.dataType
    return F.col(field.name) if same else F.col(field.name).try_cast(field.dataType)


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in order, cast; a value that does not fit becomes NULL."""
    return df.select(*[_cast(df, f).alias(f.name) for f in schema])


def _checked(df: DataFrame, rules: Rules, *carried: str) -> tuple[DataFrame, dict[str, Column]]:
    """The typed columns, ``carried`` ones and ``_reason``, and what each reason means; ``_reason`` is NULL for a row that stays."""
    watched = [*rules.required, *([rules.positive] if rules.positive else [])]
    unfit = {c: F.col(c).isNotNull() & _cast(df, rules.schema[c]).isNull() for c in watched}
    rows = df.select(
        *[_cast(df, f).alias(f.name) for f in rules.schema], *carried, *[unfit[c].alias(f"_unfit_{c}") for c in watched],
    )
    reasons: dict[str, Column] = {}
    for c in watched:
        reasons[f"{c} does not fit"] = F.col(f"_unfit_{c}")
        reasons[f"{c} missing"] = F.col(c).isNull()
    if rules.positive:
        reasons[f"{rules.positive} not positive"] = F.col(rules.positive) <= 0
    first = F.coalesce(*[F.when(bad, F.lit(reason)) for reason, bad in reasons.items()])
    return rows.select(*rules.schema.names, *carried, first.alias("_reason")), reasons


def rejects(raw: DataFrame, rules: Rules, table: str) -> DataFrame:
    """(``table_name``, ``reason``, ``row_count``) of the rows that cleaning would reject."""
    return _checked(raw, rules)[0].filter(F.col("_reason").isNotNull()).groupBy(F.col("_reason").alias("reason")).agg(
        F.count(F.lit(1)).alias("row_count")
    ).select(F.lit(table).alias("table_name"), "reason", "row_count")


def judged(text: DataFrame, rules: Rules, malformed: str) -> DataFrame:
    """Every row of a table of texts: the typed columns, ``status``, ``reason``, ``unparsed`` and ``raw_line``.

    ``status`` is ``rejected`` with the first ``reason``; ``repaired`` for a row that stays although cells in it became NULL (named in ``unparsed``) or its
    line was malformed; else ``clean``. The line is kept for the first two.
    """
    names = rules.schema.names
    unparsed = F.array_compact(F.array(*[
        F.when(F.col(f.name).isNotNull() & _cast(text, f).isNull(), F.lit(f.name)) for f in rules.schema
    ]))
    line = F.coalesce(malformed, F.to_csv(F.struct(*names)))
    carried = text.select(*names, unparsed.alias("_unparsed"), F.col(malformed).isNotNull().alias("_malformed"), line.alias("_line"))
    rows, _ = _checked(carried, rules, "_unparsed", "_malformed", "_line")
    status = (
        F.when(F.col("_reason").isNotNull(), "rejected")
        .when((F.size("_unparsed") > 0) | F.col("_malformed"), "repaired").otherwise("clean")
    )
    return rows.select(
        *names, status.alias("status"), F.col("_reason").alias("reason"), F.col("_unparsed").alias("unparsed"),
        F.when(status != "clean", F.col("_line")).alias("raw_line"),
    )


def _valid(raw: DataFrame, rules: Rules, seen: Observation | None) -> DataFrame:
    rows, reasons = _checked(raw, rules)
    if seen is not None:
        rows = rows.observe(seen, *[F.count_if(F.col("_reason") == r).alias(r) for r in reasons])
    return rows.filter(F.col("_reason").isNull()).drop("_reason")


def clean_expenses(raw: DataFrame, source_file: str | None = None, seen: Observation | None = None) -> DataFrame:
    one_each = keep_first(_valid(raw, EXPENSES, seen), ["invoice_id"], ["trx_date", "amount", "vendor_id"])
    return stamp(one_each, source_file)


def clean_budgets(raw: DataFrame, source_file: str | None = None, seen: Observation | None = None) -> DataFrame:
    return stamp(keep_first(_valid(raw, BUDGETS, seen), ["dept_id", "budget_month"]), source_file)


def clean_campaign_spend(raw: DataFrame, source_file: str | None = None, seen: Observation | None = None) -> DataFrame:
    return stamp(keep_first(_valid(raw, CAMPAIGN_SPEND, seen), ["spend_id"], ["date", "cost"]), source_file)


def clean_calendar(raw: DataFrame, source_file: str | None = None, seen: Observation | None = None) -> DataFrame:
    return stamp(keep_first(_valid(raw, CALENDAR, seen), ["date"]), source_file)
