"""Tables that are written once in their order and numbered when they are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from outlay.sources.readers import read_table
from outlay.sources.writers import write_table

PART_BITS = 33  # of monotonically_increasing_id: the place in a partition


def write_ranked(df: DataFrame, order: tuple[tuple[str, str], ...], path: str) -> int:
    """Write ``df`` sorted by ``order``, pairs of a column and ``asc`` or ``desc`` whose last column is unique; returns the rows.

    The sort is range-partitioned, by bounds that Spark samples. Each task writes its range with the rows' places in it, and beside the rows goes the
    number of rows of each range: so the rows are written once, and a rank is its place plus the rows of the ranges below.
    """
    columns = [F.col(name).desc() if way == "desc" else F.col(name).asc() for name, way in order]
    rows = write_table(df.orderBy(*columns).withColumn("_seq", F.monotonically_increasing_id()), f"{path}/rows")
    part = F.shiftright("_seq", PART_BITS).alias("_part")
    sizes = read_table(df.sparkSession, f"{path}/rows").groupBy(part).agg(F.count(F.lit(1)).alias("_size"))
    write_table(sizes, f"{path}/ranges")
    return rows


def read_ranked(spark: SparkSession, path: str, rank: str) -> DataFrame:
    """The rows of ``write_ranked`` with their 1-based ``rank``. There is one small row for each range; nothing is sorted again."""
    below = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = read_table(spark, f"{path}/ranges").select("_part", F.coalesce(F.sum("_size").over(below), F.lit(0)).alias("_below"))
    rows = read_table(spark, f"{path}/rows").withColumn("_part", F.shiftright("_seq", PART_BITS))
    place = F.col("_seq").bitwiseAND(F.lit((1 << PART_BITS) - 1))
    # As many rows as the sort had partitions.
    return rows.join(F.broadcast(offsets), "_part").withColumn(rank, F.col("_below") + place + 1).drop("_seq", "_part", "_below")
