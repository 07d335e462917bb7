"""Row numbering without a single-partition sort of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Each level of cells adds 16 bits, so no window partition can outgrow 65,536 rows.
CELL_BITS = 16


def _position(df: DataFrame, id_column: str) -> tuple[Column, int]:
    """The id as a number, and its bits."""
    kind = df.schema[id_column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(id_column)), 32
    if isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
        return F.col(id_column).cast("int"), 32
    if isinstance(kind, T.LongType):
        return F.col(id_column), 64
    raise TypeError(f"{id_column} is {kind.simpleString()}; a dense key needs an integer or a date")


def _offsets(cells: DataFrame, bits: int) -> DataFrame:
    """(``_cell``, ``_below``) for cells (``_cell``, ``_size``) with numbers of ``bits`` bits: the rows in lower cells."""
    last = bits <= CELL_BITS
    window = Window.orderBy("_cell") if last else Window.partitionBy("_upper").orderBy("_cell")
    upper = F.shiftright("_cell", CELL_BITS)
    inside = cells.withColumn("_upper", F.lit(0) if last else upper).select(
        "_cell", "_upper",
        F.coalesce(F.sum("_size").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_inside"),
    )
    if last:
        return inside.select("_cell", F.col("_inside").alias("_below"))
    above = cells.groupBy(upper.alias("_cell")).agg(F.sum("_size").alias("_size"))
    above = _offsets(above, bits - CELL_BITS).toDF("_upper", "_above")
    return inside.join(above, "_upper").select("_cell", (F.col("_inside") + F.col("_above")).alias("_below"))


def dense_key(df: DataFrame, id_column: str, key: str) -> DataFrame:
    """Add ``key``: the 1-based rank of ``id_column``, a unique integer or date (NULL ranks first).

    The id's high bits cut the table into ordered cells, 16 bits to a level; a row's rank is the number of rows
    in lower cells plus its rank inside its own cell. It depends on the values alone, so a
    recomputed partition gets the same keys. ``df`` is read twice, so pass a written table.
    """
    position, bits = _position(df, id_column)
    null_cell = -(1 << (bits - CELL_BITS - 1)) - 1  # below every id's cell
    cell = F.coalesce(F.shiftright(position, CELL_BITS).cast("bigint"), F.lit(null_cell).cast("bigint"))
    cells = df.select(cell.alias("_cell")).groupBy("_cell").agg(F.count(F.lit(1)).alias("_size"))
    offsets = _offsets(cells, bits - CELL_BITS)
    if bits == 32:
        offsets = F.broadcast(offsets)  # 65,537 rows at most
    in_cell = Window.partitionBy("_cell").orderBy(F.col(id_column).asc_nulls_first())
    return (
        df.withColumn("_cell", cell)
        .withColumn("_rank", F.row_number().over(in_cell))
        .join(offsets, "_cell")
        .withColumn(key, F.col("_below") + F.col("_rank"))
        .drop("_cell", "_rank", "_below")
    )
