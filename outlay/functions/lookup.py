"""Size-checked lookup sides, and keys looked up by runs of ids."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMALL_ROWS = 2_000_000
SMALL_BYTES = 64 << 20
RUN_BITS = 16


def stored_bytes(table: DataFrame) -> int:
    """The size of the files below a plain read of a table, as the planner knows it without a job."""
    return int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small_side(table: DataFrame, rows: int | None = None, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """``table`` with a broadcast hint if it is proven to hold at most ``max_rows`` rows and ``max_bytes`` of files.

    Use it on written tables. ``rows`` is the count that the write returned; without it the rows are counted, which sums
    one number for each task. A larger table comes back unhinted and joins by sort-merge, where adaptive execution splits hot keys.
    """
    if stored_bytes(table) > max_bytes:
        return table
    return F.broadcast(table) if (table.count() if rows is None else rows) <= max_rows else table


@dataclass
class KeyRuns:
    """A dimension's keys as runs of ids: (``_block``, ``_low``, ``_high``, ``_ahead``), where a key is its id less ``_ahead``."""

    runs: DataFrame


def key_runs(dimension: DataFrame, id_column: str, key: str) -> DataFrame:
    """The runs of consecutive ids with consecutive keys, cut at multiples of 2**16, and ``_gaps``: ids missing inside a run.

    Keys are ranks by id, so a dimension of dense ids has a run for each 65,536 members.
    """
    block, ahead = F.shiftright(F.col(id_column).cast("bigint"), RUN_BITS), F.col(id_column).cast("bigint") - F.col(key)
    return (
        dimension.filter(F.col(id_column).isNotNull()).groupBy(block.alias("_block"), ahead.alias("_ahead"))
        .agg(F.min(id_column).cast("bigint").alias("_low"), F.max(id_column).cast("bigint").alias("_high"), F.count(F.lit(1)).alias("_size"))
        .select("_block", "_ahead", "_low", "_high", (F.col("_high") - F.col("_low") + 1 - F.col("_size")).alias("_gaps"))
    )


def key_side(
    table: DataFrame, rows: int, id_column: str, key: str, settle: Callable[[DataFrame], tuple[DataFrame, int]],
    max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES,
) -> DataFrame | KeyRuns:
    """What a fact looks its keys up in: a small table hinted for broadcast, the runs of a large one if they are few and without gaps, else the table.

    Only the last costs an exchange of the fact. ``settle`` writes the runs and returns them with their number.
    """
    side = small_side(table, rows, max_rows, max_bytes)
    if side is not table or not isinstance(table.schema[id_column].dataType, T.IntegralType):
        return side
    runs, number = settle(key_runs(table, id_column, key))
    if number > max_rows or runs.filter("_gaps > 0").limit(1).count():
        return table
    return KeyRuns(F.broadcast(runs.drop("_gaps")))


def with_key(rows: DataFrame, side: DataFrame | KeyRuns, id_column: str, key: str) -> DataFrame:
    """``rows`` with the key of their id, NULL where the side has none."""
    if not isinstance(side, KeyRuns):
        return rows.join(side.select(id_column, key), id_column, "left")
    ids = F.col(id_column).cast("bigint")
    inside = (F.shiftright(ids, RUN_BITS) == F.col("_block")) & (ids >= F.col("_low")) & (ids <= F.col("_high"))
    return rows.join(side.runs, inside, "left").withColumn(key, ids - F.col("_ahead")).drop("_block", "_ahead", "_low", "_high")
