"""Line dedup against brute force."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from outlay.llm import lines

BLANKS = " \t\n\x0b\x0c\r"


def key(line: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line).strip(BLANKS)


def brute(rows: list[tuple], min_docs: int, keep: str) -> dict[int, list[str]]:
    """The kept lines of each document, documents in the order of their ids."""
    held: dict[str, set[int]] = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            held.setdefault(key(line), set()).add(doc_id)
    seen, kept = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        kept[doc_id] = []
        for line in (text or "").split("\n"):
            k = key(line)
            repeated = k != "" and len(held[k]) >= min_docs
            if not repeated or (keep == "first" and k not in seen):
                kept[doc_id].append(line)
            seen.add(k)
    return kept


@pytest.fixture(scope="module")
def rows() -> list[tuple]:
    """Random texts over few lines, a line that all share, long and empty texts, blanks and case."""
    dice = random.Random(5)
    pool = [f"line {i}" for i in range(60)] + ["", "  ", "Ünïcode Ä", "ünïcode Ä"]
    found = []
    for doc_id in range(400):
        chosen = dice.choices(pool, k=dice.randrange(0, 12))
        chosen = [dice.choice(["", " ", "\t"]) + (c.upper() if dice.random() < 0.3 else c) + dice.choice(["", "\r", "\x0b "]) for c in chosen]
        found.append((doc_id, "\n".join(["Same everywhere", *chosen, f"own {doc_id}"])))
    found.append((400, None))
    found.append((401, ""))
    found.append((402, "\n".join(["long one", *["line 3", "x"] * 20_000])))
    return found


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(7)


@pytest.mark.parametrize(("min_docs", "keep"), [(10, "none"), (50, "none"), (1, "none"), (2, "first"), (1, "first"), (40, "first")])
@pytest.mark.parametrize("parts", ["3", "40"])
def test_kept_lines_equal_brute_force(spark, rows, min_docs, keep, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r.doc_id: r for r in lines.digests(table(spark, rows), min_docs, keep).collect()}
        texts = {r.doc_id: r.text for r in lines.dedup_lines(table(spark, rows), min_docs, keep).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    expected = brute(rows, min_docs, keep)
    assert found.keys() == expected.keys() == texts.keys()
    for doc_id, text in rows:
        kept = expected[doc_id]
        assert found[doc_id].n_lines == len((text or "").split("\n"))
        assert found[doc_id].n_dropped == found[doc_id].n_lines - len(kept), doc_id
        assert found[doc_id].kept_sha256 == hashlib.sha256("\n".join(kept).encode()).hexdigest()
        assert texts[doc_id] == (None if text is None else "\n".join(kept))


def test_a_key_of_all_documents_is_spread(spark):
    """The places of one key go to several tasks, and the tasks' border runs are summed."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("one line").alias("text")).repartition(8)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        order = ["h1", "h2", "doc_id", "digest", "line"]
        places = lines._named(docs).mapInArrow(lines._places, lines.PLACES).repartitionByRange(*order)
        sizes = [r[1] for r in places.groupBy(F.spark_partition_id()).count().collect()]
        result = lines.digests(docs, 10).agg(F.sum("n_dropped"), F.min("n_dropped")).first()
        first = lines.digests(docs, 10, "first").agg(F.sum("n_dropped")).first()[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) >= 6 and max(sizes) < 1500
    assert tuple(result) == (3000, 1)
    assert first == 2999


def test_copies_nulls_and_columns(spark):
    """Rows that repeat count each; null ids are documents; clashing columns stay as they are."""
    schema = "h1 string, doc_id long, TEXT string, keep int, digest string, line int, lines int"
    rows = [("a", 1, "x\ny", 1, "d", 1, 1), ("a", 1, "x\ny", 2, "e", 1, 1), ("b", None, "x\nz", 3, "f", 1, 1), ("c", None, None, 4, None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    found = lines.dedup_lines(docs, 3, "none")
    assert found.columns == docs.columns
    assert sorted((r[0], r[2], r[3]) for r in found.collect() if r[2] is not None) == [("a", "y", 1), ("a", "y", 2), ("b", "z", 3)]
    assert lines.digests(docs, 3).count() == 4
    empty = spark.createDataFrame([], schema)
    assert lines.digests(empty, 3).count() == 0
    assert lines.dedup_lines(empty).count() == 0
    with pytest.raises(ValueError):
        lines.keep_bitmaps(docs, 0)
