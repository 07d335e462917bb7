"""N-gram Jaccard join by an LSH forest of MinHash signatures, with exact verification.

A text's set is its runs of five words (lower case, cut at ASCII white space); a text of one to four
words has the one run of all its words. Texts with the same words are one node. Every tree has its own sequence of
``DEPTH`` MinHash values of 16 bits, a node's path there.

The forest is one table of all paths of all trees, sorted by tree and path, so that a prefix is a run of neighbours, whatever its length.
It is read off in one pass: each task compares neighbours and notes, for every prefix length that may be needed, which node heads the run; runs
that go on in the next range are joined by the ranges' first and last rows.

Matching begins with whole paths: nodes are candidates if they share one in some tree. The candidates are verified, and the similarities
of the links found tell how many more there are to find: a link of similarity s is missed at prefix length d with probability
(1 - s^d)^trees. As long as the share found, averaged over the groups of candidates (and one imagined link at the threshold, so that no evidence is
not good evidence), is below ``RECALL``, the prefixes are shortened in all trees to the longest for which it would do, and what has
grown by that is verified again. The shortest length is ``matched_depth``, by which every single link at the threshold is found with that probability.

Candidates are gathered into connected groups, so that a pair that meets in many trees is verified
once. The texts of a group go to one task, which counts the common runs of all its pairs exactly
as matrix products and keeps, for each node, its number of links and its root in a spanning forest; pairs are never
written. Groups of over ``BLOCK`` nodes or ``UNIT_BYTES`` of text are cut into blocks, and each pair of blocks is a task's unit.

Null and empty texts have no run: they link with nothing and each is its own class. Null ids are allowed and
come last in the order; repeated rows are copies of each other. Extra columns are left out. Row numbers are the same in each
read of the input (``tables.numbered``).
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outlay.llm.grouping import Forest, block_units, components, runs
from outlay.llm.hashing import run_hashes, word_hashes
from outlay.llm.tables import Store, numbered, pick, slices

WORDS = 5
THRESHOLD = 0.8
TREES, DEPTH, RECALL = 24, 8, 0.9999
BLOCK, UNIT_BYTES = 512, 32 << 20
SEED = 7
COLUMNS = 4096


def matched_depth(trees: int = TREES, depth: int = DEPTH, threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """The prefix length at which a pair at the threshold is found with probability ``recall``; at least 1."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def split(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


def shingles(words: list[bytes], n: int = WORDS) -> np.ndarray:
    """The distinct 64-bit hashes of the runs of ``n`` words, sorted."""
    return np.unique(run_hashes(word_hashes(words), min(n, len(words)))) if words else np.zeros(0, np.uint64)


@lru_cache(maxsize=4)
def _functions(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**31, count, np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 2**32, count, np.uint32)


def paths(runs_of: np.ndarray, trees: int, depth: int, seed: int = SEED) -> bytes:
    """For each tree the set's ``depth`` MinHash values, two bytes each."""
    factor, shift = _functions(trees * depth, seed)
    least = np.full(trees * depth, np.iinfo(np.uint32).max, np.uint32)
    values = (runs_of >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(values), 512):
        part = values[start : start + 512, None]
        least = np.minimum(least, (part * factor + shift).min(axis=0))
    return (least ^ (least >> np.uint32(16))).astype(">u2").tobytes()


def _signed(docs: DataFrame, trees: int, depth: int, n: int) -> DataFrame:
    """Each row's number, id, digest of its words and paths; null digest and paths without a word."""

    def run(batches):
        for part in slices(batches):
            keys, found = [], []
            for text in part.column(2).to_pylist():
                words = split(text)
                keys.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None)
                found.append(paths(shingles(words, n), trees, depth) if words else None)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:2], pa.array(keys, pa.binary()), pa.array(found, pa.binary())],
                ["row", "doc_id", "key", "paths"],
            )

    return docs.mapInArrow(run, f"row long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, key binary, paths binary")


EDGE, FIRST, LAST = 0, 1, 2


def _runs_of_prefixes(sorted_paths: DataFrame, shortest: int, depth: int) -> DataFrame:
    """What neighbours share, for (``range``, ``tree``, ``path``, ``node``) in sorted order.

    An ``EDGE`` joins ``node`` to the ``head`` of its run of prefixes of ``length`` values, the greatest for that head; a ``FIRST`` and a ``LAST`` are the
    ends of a range.
    """
    names = ["kind", "range", "tree", "path", "node", "head", "length"]

    def rows(kind: int, range_: int, tree: int, path: bytes, node: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([kind], pa.int32()), pa.array([range_], pa.int64()), pa.array([tree], pa.int32()), pa.array([path], pa.binary()),
            pa.array([node], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()),
        ], names)

    def run(batches):
        last, heads = None, {}
        for batch in batches:
            count = batch.num_rows
            if not count:
                continue
            ranges, trees, nodes = (batch.column(i).to_numpy() for i in (0, 1, 3))
            values = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(count, depth)
            if last is None:
                yield rows(FIRST, int(ranges[0]), int(trees[0]), values[0].tobytes(), int(nodes[0]))
            before = values[:1] if last is None else last[1][None]
            differ = np.concatenate([before, values[:-1]]) != values
            shared = np.where(differ.any(axis=1), differ.argmax(axis=1), depth)
            shared[np.concatenate([[last is None or last[0] != trees[0]], trees[1:] != trees[:-1]])] = 0
            done = nodes.copy()
            for length in range(depth, shortest - 1, -1):
                start = np.maximum.accumulate(np.where(shared < length, np.arange(count), -1))
                head = np.where(start < 0, heads.get(length, -1), nodes[start])
                new = np.flatnonzero((head != done) & (head != nodes))
                if len(new):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(new), EDGE, np.int32)), pa.nulls(len(new), pa.int64()), pa.nulls(len(new), pa.int32()),
                        pa.nulls(len(new), pa.binary()), pa.array(nodes[new]), pa.array(head[new]), pa.array(np.full(len(new), length, np.int32)),
                    ], names)
                heads[length] = int(head[-1])
                done = head
            last = (trees[-1], values[-1].copy(), int(nodes[-1]), int(ranges[-1]))
        if last is not None:
            yield rows(LAST, last[3], int(last[0]), last[1].tobytes(), last[2])

    schema = "kind int, range long, tree int, path binary, node long, head long, length int"
    return sorted_paths.mapInArrow(run, schema)


def _forest(nodes: DataFrame, store: Store, trees: int, shortest: int, depth: int) -> DataFrame:
    """Edges (``a``, ``b``, ``length``) that connect, for each prefix length from ``shortest`` on, the nodes that share a prefix of it in a tree."""
    width = 2 * depth
    path = F.substring("paths", F.col("tree") * width + 1, F.lit(width))
    under = nodes.select("node", "paths", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    ordered = (
        under.select("tree", path.alias("path"), "node").orderBy("tree", "path", "node")
        .select(F.shiftright(F.monotonically_increasing_id(), 33).alias("range"), "tree", "path", "node")
    )
    seen = store.put("forest", _runs_of_prefixes(ordered, shortest, depth))
    # Two rows for each range of the sort, in one window.
    by_range = Window.orderBy("range", "kind")
    ends = seen.filter(F.col("kind") != EDGE).withColumns({f"last_{c}": F.lag(c).over(by_range) for c in ("tree", "path", "node")})

    def same(length: int) -> Column:
        return F.substring("path", 1, 2 * length) == F.substring("last_path", 1, 2 * length)

    length = F.coalesce(*[F.when(same(d), d) for d in range(depth, shortest - 1, -1)])
    borders = (
        ends.filter((F.col("kind") == FIRST) & (F.col("tree") == F.col("last_tree")))
        .select(F.col("node").alias("a"), F.col("last_node").alias("b"), length.alias("length")).filter("length IS NOT NULL")
    )
    return seen.filter(F.col("kind") == EDGE).select(F.col("node").alias("a"), F.col("head").alias("b"), "length").unionByName(borders)


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """The number of common elements of every two of the sorted sets."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    first = np.concatenate([[True], values[1:] != values[:-1]])
    group = np.cumsum(first) - 1
    shared = np.bincount(group)[group] > 1
    owner, group = owner[shared], group[shared]
    out = np.zeros((len(sets), len(sets)), np.float32)
    if len(owner):
        group = np.cumsum(np.concatenate([[0], np.diff(group) != 0])).astype(np.int64)
        for low in range(0, int(group[-1]) + 1, COLUMNS):
            a, b = np.searchsorted(group, [low, low + COLUMNS])
            part = np.zeros((len(sets), min(COLUMNS, int(group[-1]) + 1 - low)), np.float32)
            part[owner[a:b], group[a:b] - low] = 1
            out += part @ part.T
    out[np.arange(len(sets)), np.arange(len(sets))] = [len(s) for s in sets]
    return out


def missed(similarity: np.ndarray, length: int, trees: int) -> np.ndarray:
    """For links of these similarities that were found by prefixes of ``length``, how many were missed for each."""
    miss = (1 - similarity**length) ** trees
    return miss / np.maximum(1 - miss, 1e-9)


def _verified(units: DataFrame, threshold: float, n: int, trees: int, shortest: int, depth: int) -> DataFrame:
    """For each unit's nodes with a link: the linked rows there, the linked nodes, the node's root, and for each prefix length how many links
    were missed for those found. Units are (``part``, ``i``, ``j``)."""

    def run(batches):
        for table in runs(batches, "part", "i", "j"):
            nodes = table.column("node").to_numpy()
            order = np.argsort(nodes)
            nodes, blocks = nodes[order], table.column("block").to_numpy()[order]
            copies = table.column("copies").to_numpy()[order]
            sets = [shingles(split(t), n) for t in table.column("text").take(pa.array(order)).to_pylist()]
            common = common_counts(sets).astype(np.float64)
            sizes = common.diagonal()
            union = sizes[:, None] + sizes - common
            linked = common >= threshold * union - 1e-9
            np.fill_diagonal(linked, False)
            if table.column("i")[0] != table.column("j")[0]:
                linked &= blocks[:, None] != blocks
            forest = Forest(len(nodes))
            forest.join_all(*np.nonzero(np.triu(linked)))
            has = np.flatnonzero(linked.any(axis=1))
            at, to = np.nonzero(linked)
            similarity = common[at, to] / union[at, to]
            expected = np.stack([
                np.bincount(at, missed(similarity, length, trees), len(nodes)) for length in range(shortest, depth + 1)], axis=1)
            yield pa.RecordBatch.from_pydict({
                "part": table.column("part").combine_chunks().slice(0, 1).take(pa.array(np.zeros(len(has), np.int64))),
                "node": nodes[has], "links": (linked[has] @ copies).astype(np.int64), "linked": linked[has].sum(axis=1).astype(np.int64),
                "root": nodes[[forest.find(i) for i in has.tolist()]].astype(np.int64),
                "missed": pa.array(list(expected[has]), pa.list_(pa.float64())),
            })

    return units.mapInArrow(run, "part long, node long, links long, linked long, root long, missed array<double>")


def _links(
    nodes: DataFrame, rows: DataFrame, store: Store, threshold: float, n: int, trees: int, depth: int, recall: float, block: int,
) -> DataFrame:
    """The verified links (as ``_verified`` gives them) of all candidates, at the prefix length that reaches the recall."""
    shortest = matched_depth(trees, depth, threshold, recall)
    edges = _forest(nodes, store, trees, shortest, depth)
    imagined = [float(missed(np.array(threshold), d, trees)) for d in range(shortest, depth + 1)]
    length, found, parts = depth, None, None
    while True:
        matched = edges.filter(F.col("length") >= length).select("a", "b")
        joined = store.put(f"candidates-{length}", components(matched, store, f"candidates-{length}"))
        now = joined.withColumnRenamed("component", "part")
        sizes = store.put(f"parts-{length}", now.groupBy("part").agg(F.count(F.lit(1)).alias("size")))
        if parts is None:
            same, fresh = None, now
        else:
            # A part's id is its smallest node and parts only grow: of the same size, it is the same.
            same = parts.join(sizes, ["part", "size"], "left_semi").select("part")
            fresh = now.join(same, "part", "left_anti")
        grouped = (
            fresh.join(nodes.select("node", "copies"), "node").join(rows.select(F.col("row").alias("node"), "text"), "node")
            .withColumn("bytes", F.octet_length("text").cast("long"))
        )
        units = block_units(grouped, block, "copies", "text", weight="bytes", most=UNIT_BYTES)
        links = store.put(f"links-{length}", _verified(units, threshold, n, trees, shortest, depth))
        found = links if same is None else links.unionByName(found.join(same, "part", "left_semi"))
        parts = sizes
        if length <= shortest:
            return found
        shares = found.groupBy("part").agg(
            F.sum("linked").alias("linked"), *[F.sum(F.col("missed")[i]).alias(f"m{i}") for i in range(len(imagined))])
        total = shares.agg(
            F.count(F.lit(1)).alias("parts"),
            *[F.coalesce(F.sum(F.col(f"m{i}") / (F.col("linked") + F.col(f"m{i}"))), F.lit(0.0)).alias(f"m{i}") for i in range(len(imagined))],
        ).first()
        lost = [(total[f"m{i}"] + m / (1 + m)) / (total["parts"] + 1) for i, m in enumerate(imagined)]
        if lost[length - shortest] <= 1 - recall:
            return found
        length = max([d for d in range(shortest, length) if lost[d - shortest] <= 1 - recall], default=shortest)


def near_duplicates(
    docs: DataFrame, *, threshold: float = THRESHOLD, n: int = WORDS, trees: int = TREES, depth: int = DEPTH,
    recall: float = RECALL, block: int = BLOCK,
) -> DataFrame:
    """One row for each document row: its number ``row``, ``doc_id``,
    ``class_id`` (the first id of its class), ``n_links`` (other rows whose similarity reaches the threshold) and
    ``kept`` (one row of each class: the first by id, then by number)."""
    store = Store(docs.sparkSession, "jaccard")
    rows = _rows(numbered(docs, store, "_jaccard_row"))
    return _classes(rows, store, threshold, n, trees, depth, recall, block)


def _rows(numbered_docs: DataFrame) -> DataFrame:
    return pick(numbered_docs, "_jaccard_row", "doc_id", "text").withColumnRenamed("_jaccard_row", "row")


def _classes(
    rows: DataFrame, store: Store, threshold: float = THRESHOLD, n: int = WORDS, trees: int = TREES, depth: int = DEPTH,
    recall: float = RECALL, block: int = BLOCK,
) -> DataFrame:
    """``near_duplicates`` of (``row``, ``doc_id``, ``text``) with lasting row numbers."""
    signed = store.put("signed", _signed(rows, trees, depth, n))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row"))
    nodes = store.put("nodes", (
        signed.filter("key IS NOT NULL").groupBy("key")
        .agg(first.alias("first"), F.count(F.lit(1)).alias("copies"), F.first("paths").alias("paths"))
        .select("key", F.col("first.row").alias("node"), "first", "copies", "paths")
    ))
    found = _links(nodes, rows, store, threshold, n, trees, depth, recall, block)
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), store, "classes")
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    classed = store.put("classed", (
        nodes.drop("paths").join(linked, "node", "left").join(roots, "node", "left")
        .select("key", "first", "copies", F.coalesce("component", "node").alias("class"), F.coalesce("links", F.lit(0)).alias("links"))
    ))
    heads = classed.groupBy("class").agg(F.min("first").alias("head"))
    named = classed.join(heads, "class").select("key", "copies", "links", "head")
    members = signed.filter("key IS NOT NULL").select("row", "doc_id", "key").join(named, "key").select(
        "row", "doc_id", F.col("head.doc_id").alias("class_id"),
        (F.col("links") + F.col("copies") - 1).alias("n_links"), (F.col("row") == F.col("head.row")).alias("kept"),
    )
    alone = signed.filter("key IS NULL").select(
        "row", "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("kept"),
    )
    return members.unionAll(alone)


def keep_first_of_class(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay when each class keeps its first row; all columns stay."""
    store = Store(docs.sparkSession, "jaccard")
    rows = numbered(docs, store, "_jaccard_row")
    kept = _classes(_rows(rows), store, **options).filter("kept").select(F.col("row").alias("_jaccard_row"))
    return rows.join(kept, "_jaccard_row", "left_semi").drop("_jaccard_row")
