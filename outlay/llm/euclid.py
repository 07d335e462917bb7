"""Embedding near-duplicates by Euclidean p-stable hashing.

Vectors are normalised, so a cosine of at least ``threshold`` means a Euclidean distance of at most sqrt(2 - 2 * threshold).
A hash is a random Gaussian projection, shifted and cut into steps of ``WIDTH``; a table's bucket is the tuple of ``k`` of them.
For unrelated vectors a distance of sqrt(2) is assumed. ``k`` is chosen so that a bucket holds about one of them by
chance, and the number of tables so that a pair at the threshold shares a bucket with probability ``RECALL``.

Inside a bucket, pairs are compared by ``BITS`` signs of other projections, and those that agree on enough of them are
candidates; only a spanning forest of the candidates of a bucket is written. The vectors of a connected group of candidates are then
compared exactly, in double precision: a link is a cosine of at least the threshold. Equal vectors are one node. Buckets and
groups of over ``BLOCK`` nodes are cut into blocks, and each pair of blocks is a task's unit; pairs are never written.

Vectors that are null, empty or zero or that hold a null, an infinity or a NaN link with nothing, and vectors of different lengths
do not link with each other. Null ids are allowed (last in the order), repeated rows are equal vectors. Extra columns are left out.
``vectors`` must be a stored table.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outlay.llm.grouping import Forest, block_units, components, runs
from outlay.llm.tables import Store, pick

THRESHOLD, RECALL = 0.95, 0.9999
WIDTH = 2.0
BITS, SIGMAS = 128, 6.5
BLOCK = 512
SEED = 11


def step_probability(distance: float, width: float) -> float:
    """The chance that two points at a distance fall into one step of a Gaussian projection."""
    ratio = width / distance
    tail = math.erfc(ratio / math.sqrt(2)) / 2
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-ratio * ratio / 2))


def shape(count: int, threshold: float = THRESHOLD, recall: float = RECALL, width: float = WIDTH) -> tuple[int, int]:
    """The number of hashes in a bucket's name and the number of tables for ``count`` vectors."""
    near, far = step_probability(math.sqrt(2 - 2 * threshold), width), step_probability(math.sqrt(2), width)
    k = max(1, math.ceil(math.log(max(count, 2)) / -math.log(far)))
    tables = math.ceil(math.log(1 - recall) / math.log1p(-(near**k)))
    return k, tables


@lru_cache(maxsize=4)
def _projections(size: int, count: int, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, size])
    return rng.normal(size=(size, count)), rng.uniform(0, width, count), rng.normal(size=(size, BITS))


def normalised(raw: list | np.ndarray | None) -> np.ndarray | None:
    """The vector in double precision with length 1; None if it cannot be compared."""
    if raw is None or not len(raw):
        return None
    vector = np.array(raw, np.float64)  # a null becomes NaN
    top = np.abs(vector).max()
    if not np.isfinite(top) or top == 0:
        return None
    vector = vector / top
    return vector / np.linalg.norm(vector)


def _named(vectors: DataFrame, k: int, tables: int, width: float) -> DataFrame:
    """Each row's vector as bytes (null if it cannot be compared), its buckets in all tables, and its signs."""

    def run(batches):
        weights = np.random.default_rng(SEED + 1).integers(1, 2**62, k, np.int64).view(np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                found = [normalised(v) for v in part.column(2).to_pylist()]
                buckets: list = [None] * len(found)
                signs: list = [None] * len(found)
                by_size: dict[int, list[int]] = {}
                for i, v in enumerate(found):
                    if v is not None:
                        by_size.setdefault(len(v), []).append(i)
                for size, rows in by_size.items():
                    lines, shifts, planes = _projections(size, k * tables, width)
                    points = np.stack([found[i] for i in rows])
                    steps = np.floor((points @ lines + shifts) / width).astype(np.int64).view(np.uint64)
                    names = (steps.reshape(len(rows), tables, k) * weights).sum(axis=2, dtype=np.uint64)
                    names = (names ^ np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15) + np.arange(tables, dtype=np.uint64)
                    names = (names ^ (names >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
                    packed = np.packbits(points @ planes > 0, axis=1)
                    for at, i in enumerate(rows):
                        buckets[i], signs[i] = names[at].view(np.int64), packed[at].tobytes()
                raw = [None if v is None else v.tobytes() for v in found]
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:2], pa.array(raw, pa.binary()), pa.array(buckets, pa.list_(pa.int64())), pa.array(signs, pa.binary()),
                ], ["row", "vec_id", "vector", "buckets", "signs"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"row long, vec_id {kind}, vector binary, buckets array<long>, signs binary")


def most_differing(threshold: float) -> int:
    """The number of differing signs that a pair at the threshold stays below by ``SIGMAS`` standard deviations."""
    p = math.acos(threshold) / math.pi
    return math.ceil(BITS * p + SIGMAS * math.sqrt(BITS * p * (1 - p)))


def _candidates(units: DataFrame, threshold: float) -> DataFrame:
    most = most_differing(threshold)

    def run(batches):
        for table in runs(batches, "part", "i", "j"):
            nodes = table.column("node").to_numpy()
            order = np.argsort(nodes)
            nodes = nodes[order]
            signs = np.frombuffer(b"".join(table.column("signs").take(pa.array(order)).to_pylist()), np.uint64).reshape(len(nodes), -1)
            forest = Forest(len(nodes))
            for i in range(len(nodes) - 1):
                differing = np.bitwise_count(signs[i + 1 :] ^ signs[i]).sum(axis=1, dtype=np.int64)
                for j in np.flatnonzero(differing <= most).tolist():
                    forest.join(i, i + 1 + j)
            roots = np.array([forest.find(i) for i in range(len(nodes))])
            has = np.flatnonzero(roots != np.arange(len(nodes)))
            if len(has):
                yield pa.RecordBatch.from_pydict({"a": nodes[has], "b": nodes[roots[has]]})

    return units.mapInArrow(run, "a long, b long")


def _verified(units: DataFrame, threshold: float) -> DataFrame:
    def run(batches):
        for table in runs(batches, "part", "i", "j"):
            nodes = table.column("node").to_numpy()
            order = np.argsort(nodes)
            nodes, blocks = nodes[order], table.column("block").to_numpy()[order]
            copies = table.column("copies").to_numpy()[order]
            raw = table.column("vector").take(pa.array(order)).to_pylist()
            linked = np.zeros((len(nodes), len(nodes)), bool)
            for size in {len(v) for v in raw}:
                rows = np.array([i for i, v in enumerate(raw) if len(v) == size])
                points = np.frombuffer(b"".join(raw[i] for i in rows.tolist()), np.float64).reshape(len(rows), -1)
                linked[np.ix_(rows, rows)] = points @ points.T >= threshold
            np.fill_diagonal(linked, False)
            if table.column("i")[0] != table.column("j")[0]:
                linked &= blocks[:, None] != blocks
            forest = Forest(len(nodes))
            forest.join_all(*np.nonzero(np.triu(linked)))
            has = np.flatnonzero(linked.any(axis=1))
            if len(has):
                yield pa.RecordBatch.from_pydict({
                    "node": nodes[has], "links": (linked[has] @ copies).astype(np.int64),
                    "root": nodes[[forest.find(i) for i in has.tolist()]],
                })

    return units.mapInArrow(run, "node long, links long, root long")


def near_duplicates(
    vectors: DataFrame, *, threshold: float = THRESHOLD, recall: float = RECALL, width: float = WIDTH, block: int = BLOCK,
) -> DataFrame:
    """One row for each vector row: ``vec_id``, ``n_links`` (other rows with a cosine of at least the threshold),
    ``component_id`` (the first id reachable by links) and ``kept`` (whether that is the row's own; rows that share it all are)."""
    store = Store(vectors.sparkSession, "euclid")
    numbered = pick(vectors, "vec_id", "embedding").select(F.monotonically_increasing_id().alias("row"), "vec_id", "embedding")
    k, tables = shape(vectors.count(), threshold, recall, width)
    named = store.put("named", _named(numbered, k, tables, width))
    first = F.min(F.struct(F.col("vec_id").isNull().alias("last"), "vec_id", "row"))
    nodes = store.put("nodes", (
        named.filter("vector IS NOT NULL").groupBy("vector")
        .agg(first.alias("first"), F.count(F.lit(1)).alias("copies"), F.first("buckets").alias("buckets"), F.first("signs").alias("signs"))
        .select("vector", F.col("first.row").alias("node"), "first", "copies", "buckets", "signs")
    ))
    under = nodes.select("node", "signs", F.explode("buckets").alias("part"))
    edges = store.put("edges", _candidates(block_units(under, block, "signs"), threshold).distinct())
    groups = components(edges, store, "candidates").withColumnRenamed("component", "part")
    grouped = groups.join(nodes.select("node", "copies", "vector"), "node")
    found = store.put("links", _verified(block_units(grouped, block, "copies", "vector"), threshold))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), store, "classes")
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    classed = store.put("classed", (
        nodes.select("vector", "node", "first", "copies").join(linked, "node", "left").join(roots, "node", "left")
        .select("vector", "first", "copies", F.coalesce("component", "node").alias("class"), F.coalesce("links", F.lit(0)).alias("links"))
    ))
    heads = classed.groupBy("class").agg(F.min("first").alias("head"))
    members = (
        named.filter("vector IS NOT NULL").select("row", "vec_id", "vector")
        .join(classed.join(heads, "class").select("vector", "copies", "links", "head"), "vector")
        .select(
            "vec_id", (F.col("links") + F.col("copies") - 1).alias("n_links"), F.col("head.vec_id").alias("component_id"),
            F.col("vec_id").eqNullSafe(F.col("head.vec_id")).alias("kept"),
        )
    )
    alone = named.filter("vector IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"),
    )
    return members.unionAll(alone)
