"""Sliding day counts and their expansion back to one row per source row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK_ROWS = 4096


def centred_day_counts(df: DataFrame, entity: str, day: str, radius: int, name: str) -> DataFrame:
    """Per (entity, day): ``rows_on_day`` and ``name``, the entity's rows within ``radius`` days.

    Counting per day first means the window sees at most one row per calendar day, however
    many source rows the entity has.
    """
    daily = df.groupBy(entity, day).agg(F.count(F.lit(1)).alias("rows_on_day"))
    around = (
        Window.partitionBy(entity).orderBy(F.unix_date(F.col(day))).rangeBetween(-radius, radius)
    )
    return daily.withColumn(name, F.sum("rows_on_day").over(around))


def cut_counts(df: DataFrame, times: str, most: int) -> DataFrame:
    """Each row once for every ``most`` of its count, numbered by ``_chunk``; ``times`` becomes the chunk's part of the count."""
    last_chunk = F.floor((F.col(times) - 1) / most)
    in_chunk = F.least(F.lit(most), F.col(times) - F.col("_chunk") * most)
    return (
        df.filter(F.col(times) > 0)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)))
        .withColumn(times, in_chunk)
    )


def expand_counts(chunks: DataFrame, times: str) -> DataFrame:
    """Each row of ``cut_counts`` ``times`` times, in its place (the counting columns are dropped)."""
    return chunks.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(times)))).drop(times, "_chunk", "_copy")


def repeat_rows(df: DataFrame, times: str, *spread_by: str) -> DataFrame:
    """Each row ``times`` times (the column is dropped).

    Counts are first cut into chunks, the chunks are spread over all tasks, and only then
    expanded, so one row with a huge count is not expanded by one task.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return expand_counts(cut_counts(df, times, CHUNK_ROWS).repartition(partitions, *spread_by, "_chunk"), times)
