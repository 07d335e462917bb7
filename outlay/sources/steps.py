"""Tables that are written once in the order of their entities, each row with values of the row before it."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outlay.sources.ranked import PART_BITS
from outlay.sources.readers import read_table
from outlay.sources.writers import write_table


def _lagged(rows: DataFrame, entity: str, values: list[str], prefix: str) -> DataFrame:
    """Add ``prefix``+value: each value of the row before, where that one is in the same partition and of the same entity."""
    schema = T.StructType([*rows.schema.fields, *[T.StructField(f"{prefix}{v}", rows.schema[v].dataType) for v in values]])
    names = [entity, *values]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[pa.Array] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(batch.schema.get_field_index(n)) for n in names]
            head = last or [pa.nulls(1, c.type) for c in now]
            before = [pa.concat_arrays([h, c.slice(0, len(c) - 1)]) for h, c in zip(head, now, strict=True)]
            both_null = pc.and_(pc.is_null(before[0]), pc.is_null(now[0]))
            same = pc.or_(pc.fill_null(pc.equal(before[0], now[0]), False), both_null)
            lags = [pc.if_else(same, b, pa.scalar(None, b.type)) for b in before[1:]]
            last = [c.slice(len(c) - 1) for c in now]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lags], [*batch.schema.names, *[f"{prefix}{v}" for v in values]])

    return rows.mapInArrow(run, schema)


def write_steps(
    df: DataFrame, entity: str, order: tuple[str, ...], values: list[str], path: str, prefix: str = "prev_",
) -> int:
    """Write ``df`` sorted by ``entity`` and ``order``, whose last column is unique, with the values of each row's predecessor; returns the rows.

    One range-partitioned sort, by bounds that Spark samples, cuts the table wherever it is even, also inside an entity or a day. A task
    takes the values over from row to row. What it can't know, the predecessor of its first row, is the last row of an earlier
    range: the last rows, one for each range, are written beside the rows.
    """
    ordered = df.orderBy(entity, *order).withColumn("_seq", F.monotonically_increasing_id())
    rows = write_table(_lagged(ordered, entity, values, prefix), f"{path}/rows")
    part = F.shiftright("_seq", PART_BITS).alias("_part")
    last = F.max(F.struct("_seq", entity, *values)).alias("_last")
    write_table(read_table(df.sparkSession, f"{path}/rows").groupBy(part).agg(last), f"{path}/ends")
    return rows


def read_steps(spark: SparkSession, path: str, entity: str, values: list[str], prefix: str = "prev_") -> DataFrame:
    """The rows of ``write_steps``: one scan, and a lookup of one small row for each range; nothing is sorted or exchanged again."""
    before = F.lag("_last").over(Window.orderBy("_part"))
    ends = read_table(spark, f"{path}/ends").select("_part", before.alias("_end"))
    rows = read_table(spark, f"{path}/rows").withColumn("_part", F.shiftright("_seq", PART_BITS))
    first = F.col("_seq").bitwiseAND(F.lit((1 << PART_BITS) - 1)) == 0
    carried = first & F.col("_end").isNotNull() & F.col(entity).eqNullSafe(F.col(f"_end.{entity}"))
    # As many rows as the sort had partitions.
    return (
        rows.join(F.broadcast(ends), "_part")
        .withColumns({f"{prefix}{v}": F.when(carried, F.col(f"_end.{v}")).otherwise(F.col(f"{prefix}{v}")) for v in values})
        .drop("_seq", "_part", "_end")
    )
