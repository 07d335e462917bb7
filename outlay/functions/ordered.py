"""Previous-row values over entities of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CROWD_ROWS = 100_000
SLOTS = 256


def previous_values(
    df: DataFrame, entity: str, day: str, tie: str, values: list[str], prefix: str = "prev_", crowd: int = CROWD_ROWS,
) -> DataFrame:
    """Add ``prefix``+value: each value of the entity's previous row by (day, tie); ``tie`` is unique.

    Each (entity, day) is a window partition of its own. One with more than ``crowd`` rows is cut into about ``SLOTS`` ranges
    of ``tie``: the bounds are ties picked by a hash, so a recomputed task finds the same ones. The first row of a partition takes
    the values of the last row before it, which enters as one extra row. No task ever holds a whole entity, and the last
    rows are combined on the map side.
    """
    group, part = [entity, day], [entity, day, "_slot"]
    crowded = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > crowd)
    picked = F.pmod(F.xxhash64(tie), F.ceil(F.col("_rows") / SLOTS)) == 0
    bounds = (
        df.select(*group, tie).join(crowded, group).filter(picked)
        .groupBy(*group).agg(F.sort_array(F.collect_list(tie)).alias("_bounds"))
    )
    slot = F.coalesce(F.size(F.filter("_bounds", lambda bound: bound <= F.col(tie))), F.lit(0))
    rows = df.join(bounds, group, "left").withColumn("_slot", F.when(F.col("_bounds").isNull(), 0).otherwise(slot)).drop("_bounds")

    before = Window.partitionBy(entity).orderBy(day, "_slot")
    carried = (
        rows.groupBy(*part).agg(F.max(F.struct(tie, *values)).alias("_last"))
        .select(*part, F.lag("_last").over(before).alias("_last"))
        .filter(F.col("_last").isNotNull())
        .select(*part, *[F.col(f"_last.{v}").alias(v) for v in values], F.lit(True).alias("_carried"))
    )
    in_slot = Window.partitionBy(*part).orderBy(F.col("_carried").desc_nulls_last(), tie)
    return (
        rows.unionByName(carried, allowMissingColumns=True)
        .withColumns({f"{prefix}{v}": F.lag(v).over(in_slot) for v in values})
        .filter(F.col("_carried").isNull())
        .drop("_carried", "_slot")
    )
