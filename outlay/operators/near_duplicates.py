"""Counts of near-equal invoices without pairing up a vendor's invoices.

Two invoices of a vendor match when their dates lie at most ``days`` apart and the other
amount is within ``tolerance_pct`` of this one's. The rule only asks whether an invoice has
none, one, or at least two matches, so ``matches`` is exact below two and at least two else.

* Amounts are cut into cells so narrow that any two in one cell match. Of a vendor's amounts on one day and in one cell, only the two smallest and the two largest can
  decide anything for others, as no range of amounts that match ends on both sides inside a cell. Those in between have four matches and are settled at once.
* The rest, four at most for each vendor, day and cell, go once to blocks of (vendor, stretch of days, stretch of amounts), each also to the neighbouring
  blocks whose invoices it may match. A block holds a few thousand points at most, however many invoices its vendor has.
* A task sweeps its points in the order of their amounts, all blocks at once: in each round the points that are not settled look one place further up and
  down. Those that are left after ``ROUNDS``, at most two for each cell and stretch of ``days``, count their whole range.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELLS_IN_BLOCK = 12
ROUNDS = 48
CHUNK = 200_000
ROUNDING = 1e-9
BLOCK = ("vendor_id", "day_block", "amount_block")


def _units(df: DataFrame, name: str) -> Column:
    """The amount as a whole number of its smallest unit; one that does not fit into 64 bits fails the job."""
    kind = df.schema[name].dataType
    scale = kind.scale if isinstance(kind, T.DecimalType) else 6
    return (F.col(name).cast(T.DecimalType(min(38, 18 + scale), scale)) * (10**scale)).cast("bigint")


def _swept(days: int, tolerance_pct: float):
    """Count the matches of the points that are their block's own; the input is sorted by block and units."""
    tolerance = round(tolerance_pct * 10**6)
    whole = 100 * 10**6

    def bounds(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # The widest whole difference d with 100 d <= tolerance_pct * units, without overflow.
        width = units // whole * tolerance + units % whole * tolerance // whole
        return units - width, units + width

    def counted(keys: np.ndarray, day: np.ndarray, units: np.ndarray, rows: np.ndarray, own: np.ndarray) -> np.ndarray:
        n = len(units)
        low, high = bounds(units)
        matches = rows - 1
        for step in (1, -1):
            active = np.flatnonzero(own & (matches < 2))
            for k in range(1, ROUNDS + 1):
                other = active + step * k
                inside = (other >= 0) & (other < n)
                active, other = active[inside], other[inside]
                reached = (keys[other] == keys[active]) & (units[other] >= low[active]) & (units[other] <= high[active])
                active, other = active[reached], other[reached]
                near = np.abs(day[other] - day[active]) <= days
                matches[active[near]] += rows[other[near]]
                active = active[matches[active] < 2]
                if not len(active):
                    break
            else:
                for i in active.tolist():
                    edge = np.flatnonzero(np.diff(keys[i:] if step > 0 else keys[: i + 1][::-1]))
                    length = (edge[0] + 1) if len(edge) else (n - i if step > 0 else i + 1)
                    span = slice(i + ROUNDS + 1, i + length) if step > 0 else slice(max(0, i - length + 1), max(0, i - ROUNDS))
                    fits = (units[span] >= low[i]) & (units[span] <= high[i]) & (np.abs(day[span] - day[i]) <= days)
                    matches[i] += int(rows[span][fits].sum())
        return matches

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
            columns = [table.column(c).to_numpy() for c in (*BLOCK, "day", "units", "rows_at_point")]
            changed = np.zeros(table.num_rows, bool)
            for c in columns[:3]:
                changed[1:] |= c[1:] != c[:-1]
            own = table.column("own").to_numpy(zero_copy_only=False)
            matches = counted(np.cumsum(changed), *(c.astype(np.int64) for c in columns[3:]), own)
            result = table.select(["vendor_id", "trx_date", "amount", "rows_at_point"]).append_column("matches", pa.array(matches))
            yield from result.filter(pa.array(own)).combine_chunks().to_batches()

        def cut(table: pa.Table) -> int:
            """Where the last block begins."""
            tail = [table.column(c).to_numpy() for c in BLOCK]
            same = np.ones(table.num_rows, bool)
            for c in tail:
                same &= c == c[-1]
            return table.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= CHUNK:
                table = pa.Table.from_batches(held).combine_chunks()
                border = cut(table)
                if border:
                    yield from out(table.slice(0, border))
                held = table.slice(border).combine_chunks().to_batches()
        if sum(b.num_rows for b in held):
            yield from out(pa.Table.from_batches(held).combine_chunks())

    return run


def near_duplicate_points(fact: DataFrame, days: int, tolerance_pct: float) -> DataFrame:
    """Per (vendor_id, trx_date, amount): ``rows_at_point`` and ``matches`` of each such row."""
    if not 0 < tolerance_pct < 100:
        raise ValueError("tolerance_pct must lie between 0 and 100")
    lower, upper = log(1 - tolerance_pct / 100), log(1 + tolerance_pct / 100)
    # Amounts in one cell differ by less than a factor of 1 + 0.95 * tolerance, which leaves room for rounding.
    cell_width = log(1 + 0.95 * tolerance_pct / 100)
    block_width, block_days = CELLS_IN_BLOCK * cell_width, 2 * (days + 1)
    units = _units(fact, "amount")

    own = ["vendor_id", "trx_date", "amount", "rows_at_point"]
    points = (
        fact.filter(F.col("vendor_id").isNotNull() & (F.col("amount") > 0) & F.col("trx_date").isNotNull())
        .groupBy("vendor_id", "trx_date", "amount").agg(F.count(F.lit(1)).alias("rows_at_point"))
        .select(*own, F.floor(F.log(F.col("amount").cast("double")) / cell_width).alias("cell"))
    )
    in_cell = Window.partitionBy("vendor_id", "trx_date", "cell")
    placed = points.withColumns({
        "place": F.row_number().over(in_cell.orderBy("amount")), "points": F.count(F.lit(1)).over(in_cell),
    })
    between = (F.col("place") > 2) & (F.col("place") <= F.col("points") - 2)
    # At least two on either side.
    settled = placed.filter(between).select(*own, (F.col("rows_at_point") + 3).alias("matches"))

    day, size = F.unix_date("trx_date"), F.log(F.col("amount").cast("double"))
    home = [F.floor(day / block_days), F.floor(size / block_width)]
    # A point may be matched by amounts from its own / (1 + t) to its own / (1 - t).
    around = (
        placed.filter(~between)
        .withColumns({"day": day, "units": units, "home_day": home[0], "home_amount": home[1]})
        .withColumn("day_block", F.explode(F.sequence(F.floor((F.col("day") - days) / block_days), F.floor((F.col("day") + days) / block_days))))
        .withColumn("amount_block", F.explode(F.sequence(
            F.floor((size - upper - ROUNDING) / block_width), F.floor((size - lower + ROUNDING) / block_width))))
    )
    swept = (
        around.select(*own, "day_block", "amount_block", "day", "units", (
            (F.col("day_block") == F.col("home_day")) & (F.col("amount_block") == F.col("home_amount"))).alias("own"))
        .repartition(*BLOCK).sortWithinPartitions(*BLOCK, "units")
        .mapInArrow(_swept(days, tolerance_pct), settled.select(*own, F.col("matches").cast("bigint").alias("matches")).schema)
    )
    return settled.unionByName(swept)
