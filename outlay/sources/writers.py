"""Parquet, CSV and JSON sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from outlay.functions import cut_counts, expand_counts

# A row of a counted table stands for so many rows at most while the table is cut by ranges, so ranges of as many rows differ by this at most.
CLUSTER_COPIES = 32


def with_row_ids(df: DataFrame, name: str) -> DataFrame:
    """Add an opaque unique id in front. Nothing may shuffle the rows after this."""
    return df.select(F.monotonically_increasing_id().alias(name), "*")


def write_table(
    df: DataFrame, path: str, partition_by: str | None = None, row_id: str | None = None,
    mode: str = "overwrite", cluster_by: tuple[str, ...] = (), copies: str | None = None,
    gathered: bool = False,
) -> int:
    """Write Parquet and return the row count, observed during the write itself.

    A partitioned write is rebalanced by its partition column first: one or few files per
    value, and adaptive execution splits a value that holds much of the table; ``gathered`` says that the tasks' rows
    are such already, so nothing is exchanged. ``cluster_by``
    sorts the table by ranges, so that a filter on its first column skips files; name columns that split a hot value. ``copies``
    names a column of counts: each row is written so many times, without the column, and ``cluster_by`` exchanges and sorts
    the counted rows, in chunks that split a hot value too. ``row_id`` names an opaque id column, numbered in the writing tasks so that a retried task cannot
    repeat another task's ids.
    """
    out = df if partition_by is None or gathered else df.hint("rebalance", partition_by)
    if copies is not None:
        out = cut_counts(out, copies, CLUSTER_COPIES)
    if cluster_by:
        out = out.repartitionByRange(*cluster_by, *(["_chunk"] if copies else [])).sortWithinPartitions(*cluster_by)
    if copies is not None:
        out = expand_counts(out, copies)
    if row_id is not None:
        out = with_row_ids(out, row_id)
    seen = Observation()
    writer = out.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return seen.get["rows"]


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
