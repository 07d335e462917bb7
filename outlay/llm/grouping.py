"""Groups of sorted rows inside a task, and connected components of a table of edges."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outlay.llm.tables import Store


def runs(batches: Iterable[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """The rows of each run of equal ``keys`` (integers without nulls), for batches that are sorted by them.

    One run at a time is in memory.
    """
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys])
        cuts = np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1
        for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            key = tuple(columns[:, start].tolist())
            if held and key != current:
                yield pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(start, stop - start))
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Union-find over 0..n-1; the smallest member is the root."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = sorted((self.find(i), self.find(j)))
        self.parent[j] = i

    def join_all(self, left: np.ndarray, right: np.ndarray) -> None:
        for i, j in zip(left.tolist(), right.tolist(), strict=True):
            self.join(i, j)


def components(edges: DataFrame, store: Store, name: str) -> DataFrame:
    """(``node``, ``component``) for every end of an edge (``a``, ``b``): the smallest node reachable, itself included.

    In each round every node hooks onto the least of itself and its neighbours, and then onto what that one hooks onto; the
    ends of the edges are replaced by what they hook onto, and loops and repeated edges vanish. At least half of the nodes that still have
    edges go in each round, until no edge is left; the rounds' tables, written as they come, compose to the result.
    """
    rounds: list[DataFrame] = []
    left = store.put(f"{name}-edges-0", edges.select("a", "b").filter("a <> b").distinct())
    while left.limit(1).count():
        turn = len(rounds) + 1
        near = (
            left.unionAll(left.select("b", "a")).toDF("node", "other").groupBy("node")
            .agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("hook"))
        )
        near = store.put(f"{name}-near-{turn}", near)
        jump = near.join(near.toDF("hook", "next"), "hook").select("node", F.col("next").alias("component"))
        rounds.append(store.put(f"{name}-hooks-{turn}", jump))
        moved = (
            left.join(rounds[-1].toDF("a", "new_a"), "a").join(rounds[-1].toDF("b", "new_b"), "b")
            .select(F.col("new_a").alias("a"), F.col("new_b").alias("b")).filter("a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        )
        left = store.put(f"{name}-edges-{turn}", moved)
        store.free(f"{name}-near-{turn}", f"{name}-edges-{turn - 1}")
    if not rounds:
        return left.toDF("node", "component")
    found = rounds[0]
    for later in rounds[1:]:
        found = found.join(later.toDF("component", "further"), "component", "left").select(
            "node", F.coalesce("further", "component").alias("component")
        )
    return found


def block_units(rows: DataFrame, block: int, *carried: str, weight: str | None = None, most: int = 0) -> DataFrame:
    """Rows (``node``, ``part``, ...) of the parts with two rows or more, sorted into units (``part``, ``i``, ``j``).

    A part of up to ``block`` rows is one unit. A larger one is cut into blocks of about half that, ``block`` tells a row's
    own, and each two blocks (or one with itself) are a unit: a row is repeated once for each block, not for each partner.
    With ``weight``, a column of bytes, blocks are also cut to about half of ``most`` of these.
    """
    heavy = F.sum(weight) if weight else F.lit(0)
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("size"), heavy.alias("heavy")).filter("size > 1")
    blocks = F.when(F.col("size") <= block, 1).otherwise(F.ceil(F.col("size") / max(1, block // 2)).cast("int"))
    if weight:
        blocks = F.greatest(blocks, F.when(F.col("heavy") <= most, 1).otherwise(F.ceil(F.col("heavy") / max(1, most // 2)).cast("int")))
    return (
        rows.select("node", "part", *carried).join(sizes, "part").withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
        .repartition("part", "i", "j").sortWithinPartitions("part", "i", "j")
        .select("part", "i", "j", "block", "node", *carried)
    )
