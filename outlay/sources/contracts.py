"""Typed contracts of the published tables, and loading Parquet into them.

A load brings a source table into its contract table and commits it (see ``commits``): readers see all of it or nothing, and of two loads at
once the second starts again from what the first has committed.

* A source that a stage has published has a version. A new version replaces what earlier ones have brought in, part by part: months whose rows are
  the same stay as they are. So a batch run that is repeated, and then loaded, adds nothing.
* A source without versions is a folder to which files are added: the files that no load has recorded are appended.
* Dimensions are merged by their natural id: one row for each, with the key that the id got first (see ``key_book``), the newest attributes,
  the first creation time, and the time of the last change. Facts take these keys. Opaque ids are numbered above the highest one ever given.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import islice
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outlay.functions import keep_first, small_side
from outlay.functions.lookup import stored_bytes
from outlay.sources.commits import ATTEMPTS, CommitLog, Conflict, Files, published_version, read_folders
from outlay.sources.key_book import KeyBook
from outlay.sources.writers import write_table

BIGINT = T.LongType()
BOOLEAN = T.BooleanType()
DATE = T.DateType()
STAMP = T.TimestampNTZType()


def text(length: int) -> T.VarcharType:
    return T.VarcharType(length)


def money(precision: int, scale: int = 2) -> T.DecimalType:
    return T.DecimalType(precision, scale)


@dataclass(frozen=True)
class Field:
    name: str
    type: T.DataType
    required: bool = False
    default: str | None = None  # "sequence" or "now" for a column the input may lack


def key(name: str) -> Field:
    return Field(name, BIGINT, default="sequence")


CREATED = Field("created_timestamp", STAMP, default="now")
UPDATED = Field("updated_timestamp", STAMP, default="now")

# Names, order, types, widths and required columns of the published tables.
CONTRACTS: dict[str, tuple[Field, ...]] = {
    "dim_vendor": (
        key("vendor_key"), Field("vendor_id", BIGINT, True), Field("vendor_name", text(255)),
        Field("category", text(100)), Field("country", text(50)), CREATED, UPDATED,
    ),
    "dim_employee": (
        key("employee_key"), Field("employee_id", BIGINT, True), Field("employee_name", text(255)),
        Field("dept_id", BIGINT), Field("title", text(100)), Field("location", text(100)),
        CREATED, UPDATED,
    ),
    "dim_department": (
        key("dept_key"), Field("dept_id", BIGINT, True), Field("dept_name", text(100)),
        Field("owner", text(100)), CREATED, UPDATED,
    ),
    "dim_campaign": (
        key("campaign_key"), Field("campaign_id", BIGINT, True), Field("campaign_name", text(255)),
        Field("channel", text(100)), Field("objective", text(100)), CREATED, UPDATED,
    ),
    "dim_calendar": (
        key("calendar_key"), Field("date", DATE, True), Field("week", BIGINT),
        Field("month_key", text(7)), Field("quarter", text(2)), Field("year", BIGINT),
        Field("is_weekend", BOOLEAN), Field("is_holiday", BOOLEAN), CREATED,
    ),
    "fact_expense": (
        key("expense_id"), Field("invoice_id", text(50), True), Field("vendor_id", BIGINT),
        Field("employee_id", BIGINT), Field("dept_id", BIGINT), Field("trx_date", DATE),
        Field("amount", money(10)), Field("currency", text(3)), Field("payment_method", text(50)),
        Field("budget_month_key", text(7)), Field("vendor_key", BIGINT),
        Field("employee_key", BIGINT), Field("dept_key", BIGINT), Field("calendar_key", BIGINT),
        CREATED,
    ),
    "fact_campaign_spend": (
        Field("spend_id", text(50), True), Field("campaign_id", BIGINT), Field("channel", text(100)),
        Field("date", DATE), Field("cost", money(10)), Field("clicks", BIGINT),
        Field("impressions", BIGINT), Field("conversions", BIGINT),
        Field("attributed_revenue", money(10)), Field("calendar_key", BIGINT), CREATED,
    ),
    "fact_budget": (
        key("budget_id"), Field("dept_id", BIGINT, True), Field("dept_name", text(100)),
        Field("budget_month", text(7), True), Field("budget_amount", money(12)),
        Field("currency", text(3)), CREATED,
    ),
    "fact_leakage_signal": (
        key("signal_id"), Field("rule_name", text(100), True), Field("entity_type", text(50)),
        Field("entity_id", text(50)), Field("entity_name", text(255)), Field("signal_date", DATE),
        Field("score", money(5)), Field("details", text(1000)), CREATED,
    ),
    "summary_monthly_expenses": (
        Field("budget_month_key", text(7)), Field("total_expenses", money(12)),
        Field("expense_count", BIGINT), Field("avg_expense_amount", money(10)), CREATED,
    ),
    "summary_dept_expenses": (
        Field("dept_id", BIGINT), Field("dept_name", text(100)), Field("total_expenses", money(12)),
        Field("expense_count", BIGINT), CREATED,
    ),
    "summary_campaign_performance": (
        Field("campaign_id", BIGINT), Field("total_cost", money(12)), Field("total_clicks", BIGINT),
        Field("total_conversions", BIGINT), Field("total_revenue", money(12)),
        Field("roas", money(10, 4)), CREATED,
    ),
}

# The tables the bulk load fills, in load order.
LOADED_TABLES = (
    "dim_vendor", "dim_employee", "dim_department", "dim_campaign", "dim_calendar",
    "fact_expense", "fact_campaign_spend",
    "summary_monthly_expenses", "summary_dept_expenses", "summary_campaign_performance",
)


def _reject(table: str, field: Field, bad: Column, reason: str, value: Column) -> Column:
    message = F.lit(f"{table}.{field.name}: {reason}")
    return F.when(bad, F.raise_error(message).cast(value_type(field))).otherwise(value)


def value_type(field: Field) -> T.DataType:
    return T.StringType() if isinstance(field.type, T.VarcharType) else field.type


def _widened(field: Field) -> Field:
    if isinstance(field.type, T.DecimalType):
        return replace(field, type=T.DecimalType(38, field.type.scale))
    return field


def _column(df: DataFrame, table: str, field: Field, keys_after: int) -> Column:
    if field.name in df.columns:
        value = F.col(field.name).cast(value_type(field))
    elif field.default == "sequence":
        value = F.monotonically_increasing_id() + (keys_after + 1)
    elif field.default == "now":
        value = F.current_timestamp().cast(value_type(field))
    else:
        value = F.lit(None).cast(value_type(field))
    if isinstance(field.type, T.VarcharType):
        longer = F.char_length(value) > field.type.length
        value = _reject(table, field, longer, f"longer than {field.type.length} characters", value)
    if field.required:
        value = _reject(table, field, value.isNull(), "NULL in a required column", value)
    return value.alias(field.name)


def conform(df: DataFrame, table: str, wide_money: bool = False, keys_after: int = 0) -> DataFrame:
    """``df`` with exactly the contract's columns, types and order.

    Missing columns are filled (sequence, current time or NULL) and others dropped. A NULL in
    a required column, an over-long text or a value that does not fit its type fails the job.
    ``wide_money`` gives money columns 38 digits, for totals that outgrow the declared ones. A
    sequence starts above ``keys_after``.
    """
    fields = CONTRACTS[table]
    if wide_money:
        fields = tuple(_widened(f) for f in fields)
    return df.select(*[_column(df, table, f, keys_after) for f in fields])


def fact_budget(budgets: DataFrame) -> DataFrame:
    """The published budget fact: the cleaned budgets that have a month (see ``budgets_without_month``)."""
    return conform(budgets.filter(F.col("budget_month").isNotNull()), "fact_budget")


def budgets_without_month(budgets: DataFrame) -> DataFrame:
    """The cleaned budgets that the published fact cannot hold."""
    return budgets.filter(F.col("budget_month").isNull())


FILES = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("length", T.LongType()), T.StructField("modified", T.TimestampType()),
])
IDENTITY = ["path", "length", "modified"]
FILES_AT_ONCE = 10_000
# A source of at most so many files for each part, or of files of at least these bytes on the average, is loaded without gathering its parts anew.
PART_FILES, FILE_BYTES = 4, 32 << 20
LOAD = "load_folder"
PARTITIONS = {"fact_expense": "budget_month_key"}
WHOLE = "*"  # the part of a table without partitions
NULL_PART = "__HIVE_DEFAULT_PARTITION__"
# The natural id and the lasting key of each dimension, and where a fact refers to it.
NATURAL = {
    "dim_vendor": ("vendor_id", "vendor_key"), "dim_employee": ("employee_id", "employee_key"),
    "dim_department": ("dept_id", "dept_key"), "dim_campaign": ("campaign_id", "campaign_key"),
    "dim_calendar": ("date", "calendar_key"),
}
REFERENCES = {
    "fact_expense": {"dim_vendor": "vendor_id", "dim_employee": "employee_id", "dim_department": "dept_id", "dim_calendar": "trx_date"},
    "fact_campaign_spend": {"dim_calendar": "date"},
}
CLOCK = ("created_timestamp", "updated_timestamp", "ingestion_timestamp")


def key_book(spark: SparkSession, store_dir: str, dimension: str) -> KeyBook:
    """The lasting keys of a dimension below a folder of tables."""
    return KeyBook(spark, f"{store_dir}/_keys/{dimension}", *NATURAL[dimension])


def _opaque(table: str) -> str | None:
    """The table's column of ids that mean nothing outside it."""
    if table in NATURAL:
        return None
    return next((f.name for f in CONTRACTS[table] if f.default == "sequence"), None)


def _prints(source: DataFrame, table: str) -> dict[str, list]:
    """For each part of the source the number of its rows and two sums of their hashes, whatever their order."""
    by = PARTITIONS.get(table)
    part = F.coalesce(F.col(by).cast("string"), F.lit(NULL_PART)) if by else F.lit(WHOLE)
    columns = sorted(c for c in source.columns if c not in CLOCK and c != _opaque(table))

    def total(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")).cast("string")

    found = source.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), total(1).alias("a"), total(2).alias("b"))
    return {r["part"]: [r["n"], r["a"], r["b"]] for r in found.collect()}


def _part_folder(spark: SparkSession, table: str, folder: str, part: str) -> str:
    if part == WHOLE:
        return folder
    name = part if part == NULL_PART else (
        spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(part))
    return f"{folder}/{PARTITIONS[table]}={name}"


def _gathered(source: DataFrame, by: str | None) -> bool:
    """The files hold one part each and are few or large, so tasks that read them write few files for each part."""
    files = source.inputFiles() if by else []
    parts = {file.rsplit("/", 1)[0] for file in files}
    named = all(f"/{by}=" in file for file in files)
    return bool(files) and named and len(files) <= PART_FILES * len(parts) + stored_bytes(source) // FILE_BYTES


class _Target:
    """A contract table and the loads that it consists of."""

    def __init__(self, spark: SparkSession, target_dir: str, table: str):
        self.spark, self.dir, self.table = spark, target_dir, table
        self.base = f"{target_dir}/{table}"
        self.log = CommitLog(spark, f"{target_dir}/_commits/{table}")

    def folders(self, state: dict[str, Any]) -> list[str]:
        """The folders that make up the table."""
        parts = [part["folder"] for source in state.get("sources", {}).values() for part in source["parts"].values()]
        return [*parts, *state.get("appended", []), *([state["merged"]] if "merged" in state else [])]

    def read(self, state: dict[str, Any]) -> DataFrame | None:
        return read_folders(self.spark, self.base, self.folders(state))

    def write(self, df: DataFrame, wide: bool, keys_after: int, gathered: bool = False) -> tuple[str, int, int]:
        """Write rows to a folder of their own: its name, the rows, and the highest opaque id. ``gathered`` rows come part by part."""
        folder, opaque = f"{LOAD}={uuid.uuid4().hex}", _opaque(self.table)
        rows = conform(df.drop(opaque) if opaque else df, self.table, wide, keys_after)
        written = write_table(rows, f"{self.base}/{folder}", partition_by=PARTITIONS.get(self.table), gathered=gathered)
        highest = self.spark.read.parquet(f"{self.base}/{folder}").agg(F.max(opaque)).first()[0] if opaque and written else None
        return folder, written, max(highest or 0, keys_after)

    def discard(self, folder: str) -> None:
        Files(self.spark, self.base).delete(folder)

    def with_keys(self, source: DataFrame) -> tuple[DataFrame, bool]:
        """The fact with the keys that this store's dimensions have; where it has no such dimension, the input's stay. And whether it is still gathered."""
        fact, gathered = source, _gathered(source, PARTITIONS.get(self.table))
        for dimension, reference in REFERENCES.get(self.table, {}).items():
            book = key_book(self.spark, self.dir, dimension)
            known = book.read()
            if known is not None and reference in fact.columns:
                table = known.select(F.col(book.id_column).alias("_id"), F.col(book.key).alias("_key"))
                keys = small_side(table)
                gathered = gathered and keys is not table  # only a broadcast leaves the rows where they are
                fact = fact.drop(book.key).join(keys, F.col(reference) == F.col("_id"), "left").withColumnRenamed("_key", book.key).drop("_id")
        return fact, gathered

    def merged(self, incoming: DataFrame, state: dict[str, Any]) -> DataFrame:
        """The dimension after a merge by natural id; ids that the input lacks stay."""
        natural, key = NATURAL[self.table]
        fields = [f for f in CONTRACTS[self.table] if f.name not in (natural, key, *CLOCK)]
        incoming = conform(incoming, self.table)
        new = keep_first(incoming.drop(key), [natural], [f.name for f in fields])
        book = key_book(self.spark, self.dir, self.table)
        keys = book.assign(new)
        old = self.read(state)
        if old is None:
            return book.look_up(new, keys)
        old = old.select(F.col(natural).alias("_id"), F.lit(True).alias("_old"), *[
            F.col(f.name).alias(f"_{f.name}") for f in CONTRACTS[self.table] if f.name not in (natural, key)])
        both = new.withColumn("_new", F.lit(True)).join(old, F.col(natural) == F.col("_id"), "full")
        same = F.lit(True)
        for f in fields:
            same = same & F.col(f.name).eqNullSafe(F.col(f"_{f.name}"))

        def first(name: str) -> Column:
            return F.coalesce(f"_{name}", name).alias(name)

        def newest(name: str) -> Column:
            return F.when(F.col("_new"), F.col(name)).otherwise(F.col(f"_{name}")).alias(name)

        columns = [F.coalesce(natural, "_id").alias(natural), *[newest(f.name) for f in fields], first("created_timestamp")]
        if any(f.name == "updated_timestamp" for f in CONTRACTS[self.table]):
            untouched = F.col("_old") & (F.col("_new").isNull() | same)
            columns.append(F.when(untouched, F.col("_updated_timestamp")).otherwise(F.col("updated_timestamp")).alias("updated_timestamp"))
        return book.look_up(both.select(*columns), keys)


def _written(target: _Target, source: DataFrame, wide: bool, keys_after: int) -> tuple[str, int, int]:
    keyed, gathered = target.with_keys(source)
    return target.write(keyed, wide, keys_after, gathered)


def _new_files(spark: SparkSession, source_dir: str, target: _Target, state: dict[str, Any]) -> Iterator[list]:
    """The files that no load has recorded, some at a time: the comparison is a join, and no list of all of them is made."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
        .load(f"{source_dir}/{target.table}").select("path", "length", F.col("modificationTime").alias("modified"))
    )
    records = [f"{target.dir}/_files/{target.table}/{f}" for f in state.get("files", [])]
    if records:
        found = found.join(spark.read.schema(FILES).parquet(*records), IDENTITY, "left_anti")
    rows = found.toLocalIterator()
    while some := list(islice(rows, FILES_AT_ONCE)):
        yield some


def _load_version(target: _Target, source_dir: str, version: int, state: dict[str, Any], wide: bool) -> tuple[dict[str, Any], int, str | None]:
    """Replace the parts that differ from what earlier versions of the source have brought in: the new state, the rows, the folder written."""
    spark, table = target.spark, target.table
    source = spark.read.parquet(f"{source_dir}/{table}")
    sources = dict(state.get("sources", {}))
    had = sources.get(source_dir, {"parts": {}})["parts"]
    if table in NATURAL:
        folder, rows, _ = target.write(target.merged(source, state), wide, 0)
        sources[source_dir] = {"version": version, "parts": {}}
        return {**state, "sources": sources, "merged": folder}, source.count(), folder
    prints = _prints(source, table)
    changed = [part for part, seen in prints.items() if part not in had or had[part]["print"] != seen]
    parts = {part: kept for part, kept in had.items() if part in prints and part not in changed}
    after, rows, folder = state.get("last_key", 0), 0, None
    if changed:
        by = PARTITIONS.get(table)
        if by and len(changed) < len(prints):
            named = F.coalesce(F.col(by).cast("string"), F.lit(NULL_PART))
            source = source.filter(F.col(by).isin([p for p in changed if p != NULL_PART]) | (
                F.col(by).isNull() if NULL_PART in changed else F.lit(False))) if len(changed) < 1000 else source.filter(named.isin(changed))
        folder, rows, after = _written(target, source, wide, after)
        for part in changed:
            parts[part] = {"folder": _part_folder(spark, table, folder, part), "print": prints[part]}
    sources[source_dir] = {"version": version, "parts": parts}
    return {**state, "sources": sources, "last_key": after}, rows, folder


def _load_files(target: _Target, source_dir: str, files: list, state: dict[str, Any], wide: bool) -> tuple[dict[str, Any], int, str]:
    """Append (or, of a dimension, merge) the rows of some files: the new state, the rows, the folder written."""
    spark, table = target.spark, target.table
    source = spark.read.option("basePath", f"{source_dir}/{table}").parquet(*sorted(row["path"] for row in files))
    if table in NATURAL:
        folder, _, after = target.write(target.merged(source, state), wide, 0)
        rows, placed = source.count(), {"merged": folder}
    else:
        folder, rows, after = _written(target, source, wide, state.get("last_key", 0))
        placed = {"appended": [*state.get("appended", []), folder], "last_key": after}
    record = spark.createDataFrame([tuple(row[c] for c in IDENTITY) for row in files], FILES)
    record.coalesce(1).write.parquet(f"{target.dir}/_files/{table}/{folder}")
    return {**state, **placed, "files": [*state.get("files", []), folder]}, rows, folder


def load_table(spark: SparkSession, source_dir: str, target_dir: str, table: str, wide_money: bool | None = None) -> int:
    """Bring what is new in ``source_dir/table`` into the contract table; returns the rows that were read for it.

    ``wide_money`` defaults to true for the summaries, whose totals grow. Raises ``Conflict`` if other loads are faster every time.
    """
    wide = table.startswith("summary_") if wide_money is None else wide_money
    target = _Target(spark, target_dir, table)
    version, total = published_version(spark, source_dir, table), 0
    for _ in range(ATTEMPTS):
        number, state = target.log.latest()
        try:
            if version:
                if state.get("sources", {}).get(source_dir, {}).get("version", 0) >= version:
                    return total
                state, rows, folder = _load_version(target, source_dir, version, state, wide)
                _commit(target, number + 1, state, folder)
                return rows
            for files in _new_files(spark, source_dir, target, state):
                state, rows, folder = _load_files(target, source_dir, files, state, wide)
                _commit(target, number + 1, state, folder)
                number, total = number + 1, total + rows
            return total
        except Conflict:
            continue
    raise Conflict(f"{table}: no free number after {ATTEMPTS} attempts")


def _commit(target: _Target, number: int, state: dict[str, Any], folder: str | None) -> None:
    try:
        target.log.commit(number, state)
    except Conflict:
        if folder:
            target.discard(folder)
        raise


def read_loaded(spark: SparkSession, target_dir: str, table: str) -> DataFrame:
    """All rows of the contract table."""
    target = _Target(spark, target_dir, table)
    names = [f.name for f in CONTRACTS[table]]
    stored = target.read(target.log.latest()[1])
    if stored is None:
        return conform(spark.range(0), table).select(*names)
    return stored.select(*names)


def load_all(spark: SparkSession, source_dir: str, target_dir: str) -> dict[str, int]:
    return {table: load_table(spark, source_dir, target_dir, table) for table in LOADED_TABLES}


def remove_unnamed(spark: SparkSession, target_dir: str, table: str) -> int:
    """Delete the load folders that the table no longer consists of; returns their number. No load or old reader may be at work."""
    target = _Target(spark, target_dir, table)
    named = {folder.split("/")[0] for folder in target.folders(target.log.latest()[1])}
    files = Files(spark, target.base)
    old = [name for name in files.names() if name.startswith(f"{LOAD}=") and name not in named]
    for name in old:
        files.delete(name)
    return len(old)
