"""Lasting row numbers, long words, and what the contracts say about letters and repeated ids."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from outlay.llm import decontamination, euclid, jaccard, language, lattice, substrings
from outlay.llm.tables import Store, numbered


@pytest.fixture(scope="module")
def many_files(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("table") / "d.parquet")
    dice = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, " ".join(f"w{dice.randrange(500)}" for _ in range(60)) + (f" {passage}" if i % 9 == 0 else "")) for i in range(600)]
    rows += [(1000 + i, rows[i][1]) for i in range(0, 600, 7)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(6).write.option("maxRecordsPerFile", 40).parquet(path)
    return path


def splits(spark, parallelism):
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", str(parallelism))


@pytest.fixture
def any_splits(spark):
    yield
    for name in ("spark.sql.files.openCostInBytes", "spark.sql.leafNodeDefaultParallelism"):
        spark.conf.unset(name)


def test_numbers_do_not_depend_on_splits(spark, many_files, any_splits):
    found = []
    for parallelism in (2, 7):
        splits(spark, parallelism)
        docs = spark.read.parquet(many_files)
        rows = numbered(docs, Store(spark, "test"))
        assert rows.columns == ["row", "doc_id", "text"]
        found.append({r.row: (r.doc_id, r.text) for r in rows.collect()})
        assert len(found[-1]) == docs.count()
    assert found[0] == found[1]


def test_results_that_change_splits_halfway_stay_whole(spark, many_files, any_splits, monkeypatch):
    """Each stored step halves or doubles the number of splits, as lost and added executors do."""
    put, turn = Store.put, iter(range(10_000))

    def changing(self, name, df):
        splits(spark, (2, 7)[next(turn) % 2])
        return put(self, name, df)

    splits(spark, 7)
    docs = spark.read.parquet(many_files)
    want_join = {(r.doc_id, r.class_id, r.n_links) for r in jaccard.near_duplicates(docs).collect()}
    want_words = {tuple(r) for r in substrings.digests(docs).collect()}
    monkeypatch.setattr(Store, "put", changing)
    assert {(r.doc_id, r.class_id, r.n_links) for r in jaccard.near_duplicates(docs).collect()} == want_join
    assert {tuple(r) for r in substrings.digests(docs).collect()} == want_words


def test_other_tables_are_numbered_once(spark):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.rand().alias("text"))
    rows = numbered(docs, Store(spark, "test"), "n")
    assert rows.select("n").distinct().count() == 50
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, rows.collect()))
    both = spark.createDataFrame([(1, "a", "b")], "doc_id long, text string, _metadata string")
    assert numbered(both, Store(spark, "test")).columns == ["row", "doc_id", "text", "_metadata"]
    assert numbered(both.limit(0), Store(spark, "test")).count() == 0


@pytest.fixture(scope="module")
def pieces():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        return lattice.Pieces.from_ranks(file.read())


def test_pieces_are_found_by_hash(pieces):
    dice = np.random.default_rng(1)
    places = dice.integers(0, len(pieces.hashes), 5000)
    assert (pieces._find(pieces.hashes[places]) == places).all()
    others = dice.integers(0, 2**63, 5000).astype(np.uint64)
    others = others[~np.isin(others, pieces.hashes)]
    assert (pieces._find(others.reshape(2, -1)) == -1).all()
    crowded = np.array([5, 5 + 64, 5 + 128, 6, 7, 5 + 192], np.uint64)  # all want the same few slots
    slots = lattice._slots(crowded)
    assert sorted(slots[slots >= 0].tolist()) == list(range(6))


def test_long_words_in_stretches_equal_whole_ones(pieces, monkeypatch):
    dice = random.Random(6)
    words = ["".join(dice.choice(["the", "ing", "x", "9", "größe", "Qz", "\x00"]) for _ in range(n)).encode() for n in (150, 400, 90)]
    counts = np.array([[2.0, 0.0], [1.0, 3.0], [0.0, 1.0]])
    other = pieces.weighted(np.arange(1.0, len(pieces.hashes) + 1), 10.0)
    whole = pieces.marginals(words, (other,)), pieces.expected(words, counts), pieces.expected(words, counts, (pieces, other))
    monkeypatch.setattr(lattice, "LONG", 64)
    parts = pieces.marginals(words, (other,)), pieces.expected(words, counts), pieces.expected(words, counts, (pieces, other))
    for a, b in zip(whole, parts, strict=True):
        assert np.allclose(a, b, rtol=1e-9, atol=1e-9)


def test_columns_of_own_scores_equal_single_ones(pieces):
    words, counts = [b"the", b"thing", b"xyzzy"], np.array([[2.0, 0.0], [1.0, 3.0], [0.0, 1.0]])
    other = pieces.weighted(np.arange(1.0, len(pieces.hashes) + 1), 10.0)
    both = pieces.expected(words, counts, (pieces, other))
    for k, own in enumerate((pieces, other)):
        seen = np.flatnonzero(counts[:, k])
        assert np.allclose(both[k], own.expected([words[i] for i in seen], counts[seen, k : k + 1])[0])


def test_a_word_of_a_megabyte(pieces):
    word = ("QmFzZTY0" * 131_072).encode()
    found = pieces.marginals([word, b"the"])
    assert np.isfinite(found).all() and found[0, 0] < -100_000


def test_letters_of_unknown_scripts_get_a_language(documents):
    model = language.learn(documents((1, "the cat sat", "en"), (2, "le chat", "fr")))
    rows = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(documents((1, "привет"), (2, "123"), (3, None)), model).collect()}
    assert rows == {1: ("en", 0.0), 2: ("und", 0.0), 3: ("und", 0.0)}
    assert [r.doc_id for r in language.keep_identified(documents((1, "привет"), (2, "123"), (3, None)), model).collect()] == [1]


def test_rows_that_share_the_first_id_are_all_kept(stored):
    table = stored([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.01]), (None, [0.0, 1.0]), (None, [0.0, 1.0])], "vec_id long, embedding array<float>")
    found = sorted((str(r.vec_id), str(r.component_id), r.n_links, r.kept) for r in euclid.near_duplicates(table).collect())
    assert found == [("1", "1", 2, True), ("1", "1", 2, True), ("2", "1", 2, False), ("None", "None", 1, True), ("None", "None", 1, True)]


@pytest.mark.parametrize("seed", range(4))
def test_overlaps_equal_a_scan_of_all_alignments(documents, stored, seed):
    """Items of 5 to 40 words, whole or in part, with up to a fifth of the words changed, in random texts."""
    dice = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(4000)]
    items = [[dice.choice(vocabulary) for _ in range(dice.randrange(5, 41))] for _ in range(25)]
    texts = []
    for _ in range(120):
        words = [dice.choice(vocabulary) for _ in range(dice.randrange(0, 30))]
        for item in dice.sample(items, dice.randrange(0, 3)):
            part = list(item[dice.randrange(0, 3):])
            for _ in range(dice.randrange(0, len(part) // 5 + 2)):
                part[dice.randrange(len(part))] = dice.choice(vocabulary)
            words += part + [dice.choice(vocabulary) for _ in range(dice.randrange(0, 10))]
        texts.append(words)
    expected = set()
    for row, words in enumerate(texts):
        for number, item in enumerate(items):
            best = None
            for shift in range(-len(item) + 1, len(words)):
                first, last = max(0, -shift), min(len(item), len(words) - shift)
                equal = np.array([words[shift + k] == item[k] for k in range(first, last)], bool)
                start, end = decontamination.longest_stretch(equal, 0.8)
                if end - start >= min(13, len(item)):
                    claim = (-int(equal[start:end].sum()), shift + first + start, end - start)
                    best = min(best or claim, claim)
            if best:
                expected.add((row, number, best[1], best[2], -best[0]))
    docs = documents(*[(i, " ".join(words)) for i, words in enumerate(texts)])
    bench = stored([(i, " ".join(words)) for i, words in enumerate(items)], "item_id long, text string")
    found = {tuple(r) for r in decontamination.find_overlaps(docs, bench).collect()}
    assert len(expected) > 40 and found == expected
