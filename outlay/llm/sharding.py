"""Two-pass external shuffle into shards of equal row counts.

Pass one scatters the rows over buckets of about ``bucket_bytes`` by a seeded hash of the row's
place in the input, so that equal ids and equal texts spread like any others. Pass two takes a
bucket at a time, in the order of the rows' places, applies a Fisher-Yates shuffle seeded by the
bucket, and writes the bucket. The buckets in a row are one random order of all rows: a row's
position is the number of rows in earlier buckets plus its place in its own, its shard is the
position modulo the number of shards and its slot the quotient. So counts differ by one at most,
slots have no gaps, and the same stored input gives the same order again.

A task holds one bucket; a single row cannot be cut. Nulls stay as they are, repeated rows stay
repeated, an empty table gives an empty result. Input columns that are named like the added ones (``shard``,
``slot``) are replaced; names with a leading ``_shuffle`` are reserved.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outlay.llm.tables import Store

SEED = 20_260_101
BUCKET_BYTES = 16 << 20
MOST_BROADCAST = 1 << 20  # rows of two numbers


def _shuffled(rows: list[pa.RecordBatch], seed: int, bucket: int) -> pa.RecordBatch:
    """One bucket in the order of a Fisher-Yates shuffle, which is what numpy's generator runs."""
    table = pa.Table.from_batches(rows).combine_chunks()
    order = np.arange(table.num_rows)
    np.random.default_rng([seed, bucket]).shuffle(order)
    return table.take(pa.array(order))


def external_shuffle(
    docs: DataFrame, shards: int, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, size_of: str = "text",
) -> DataFrame:
    """All rows and columns with ``shard`` and ``slot``, read from the written buckets."""
    if shards < 1:
        raise ValueError("there must be a shard")
    spark = docs.sparkSession
    docs = docs.drop("shard", "slot")
    total = docs.agg(F.sum(F.octet_length(F.coalesce(F.col(size_of), F.lit(""))) + 64)).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    parts = min(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    columns = docs.columns
    scattered = (
        docs.withColumn("_shuffle_row", F.monotonically_increasing_id())
        .withColumn("_shuffle_bucket", F.pmod(F.xxhash64(F.lit(seed), "_shuffle_row"), F.lit(buckets)))
        .repartitionById(parts, (F.col("_shuffle_bucket") % parts).cast("int"))
        .sortWithinPartitions("_shuffle_bucket", "_shuffle_row")
        .select(*columns, "_shuffle_bucket")
    )
    schema = T.StructType([*scattered.schema.fields, T.StructField("_shuffle_place", T.LongType(), False)])

    def run(batches):
        held: list[pa.RecordBatch] = []
        current = None

        def out():
            table = _shuffled(held, seed, current)
            table = table.append_column("_shuffle_place", pa.array(np.arange(table.num_rows), pa.int64()))
            yield from table.to_batches(max_chunksize=1000)

        for batch in batches:
            keys = batch.column(len(columns)).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for start, stop in zip(cuts, cuts[1:], strict=False):
                if start == stop:
                    continue
                if held and current != keys[start]:
                    yield from out()
                    held = []
                current = int(keys[start])
                held.append(batch.slice(start, stop - start))
        if held:
            yield from out()

    written = Store(spark, "shuffle").put("buckets", scattered.mapInArrow(run, schema))
    # One row for each bucket, so as many as the input has times ``bucket_bytes``.
    below = Window.orderBy("_shuffle_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        written.groupBy("_shuffle_bucket").agg(F.count(F.lit(1)).alias("_shuffle_rows"))
        .select("_shuffle_bucket", F.coalesce(F.sum("_shuffle_rows").over(below), F.lit(0)).alias("_shuffle_below"))
    )
    position = F.col("_shuffle_below") + F.col("_shuffle_place")
    side = F.broadcast(offsets) if buckets <= MOST_BROADCAST else offsets
    return written.join(side, "_shuffle_bucket").select(
        *columns, (position % shards).cast("int").alias("shard"), F.floor(position / shards).cast("long").alias("slot"),
    )


def write_shards(shuffled: DataFrame, path: str) -> None:
    """One folder for each shard, its rows in the order of their slots from file to file."""
    (
        shuffled.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard").parquet(path)
    )


def digests(docs: DataFrame, shards: int) -> DataFrame:
    """``doc_id``, size and crc32 of the text, and the place that the shuffle gave the row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return external_shuffle(docs, shards).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
