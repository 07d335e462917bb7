"""Collocations against brute force, for every split into phrases with and without ids."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from outlay.llm import collocations as cl
from outlay.llm.hashing import word_hashes


def brute(rows, min_count, max_words, top):
    """All phrases counted by their words, all cuts, all longer candidates."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    found = []
    for lang, of in counts.items():
        candidates = {p: a for p, a in of.items() if len(p) > 1 and a >= min_count}
        scored = []
        for p, a in candidates.items():
            inside = any(
                len(q) > len(p) and 100 * b >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in candidates.items()
            )
            if not inside:
                score, k = min((1000 * a * totals[lang] // (of[p[:k]] * of[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), of[p[:k]], of[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


@pytest.fixture(scope="module")
def rows():
    dice = random.Random(11)
    found = []
    for lang, size in (("en", 30), ("de", 30), (None, 12), ("x", 3)):
        vocabulary = [f"w{i}" for i in range(size)] + ["Größe", "the", "A b", "\x1cq"]
        for _ in range(60):
            words = dice.choices(vocabulary, weights=[1 / (i + 1) for i in range(len(vocabulary))], k=dice.randrange(0, 40))
            found.append((lang, "".join(w + dice.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", " set PHRASE of five words "]) for w in words)))
    return [*found, ("en", None), (None, ""), ("de", " ., \t"), ("only gaps", "!?"), ("x", "the the the the the the")]


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string").repartition(5)


@pytest.mark.parametrize(("min_count", "max_words", "top", "most_ids"), [
    (5, 5, 2000, cl.LIMIT), (5, 5, 2000, 20), (3, 4, 2000, 60), (2, 5, 50, 200), (3, 3, 10, 0), (4, 1, 10, 5),
])
def test_equals_brute_force(spark, rows, min_count, max_words, top, most_ids):
    found = cl.collocations(table(spark, rows), min_count, max_words, top, most_ids)
    assert sorted(map(tuple, found.collect())) == brute(rows, min_count, max_words, top)


def test_small_tiles_and_lists_are_flushed():
    """Dense and sorted tiles give the same sums as one Counter, also when they are emptied in between."""
    dice = np.random.default_rng(3)
    left = dice.zipf(1.3, 200_000) % cl.LIMIT
    right = dice.zipf(1.3, 200_000) % cl.LIMIT
    tiles, found = cl.Tiles(dense_from=500, dense_tiles=2, sparse=1000), Counter()
    for start in range(0, len(left), 20_000):
        tiles.add(left[start : start + 20_000], right[start : start + 20_000])
        assert 1 <= len(tiles.dense) <= 2
        if tiles.full():
            for cells, counts in tiles.out():
                for cell, count in zip(cells.tolist(), counts.tolist(), strict=True):
                    found[cell] += count
    for cells, counts in tiles.out():
        for cell, count in zip(cells.tolist(), counts.tolist(), strict=True):
            found[cell] += count
    assert found == Counter(((left << cl.ID_BITS) | right).tolist())


def test_bitmap_holds_the_hashes_that_tasks_look_up(spark):
    def hashes(phrases):
        words = [word_hashes(p.encode().split(b" ")) for p in phrases]
        return np.array([cl._phrase_hashes(w, len(w))[0] for w in words])

    phrases = [f"phrase {i} é" for i in range(500)]
    bits = cl._bitmap(spark.createDataFrame([(p,) for p in phrases], "phrase string"))
    assert cl._in_bitmap(bits, hashes(phrases)).all()
    assert cl._in_bitmap(bits, hashes([f"other {i} é" for i in range(2000)])).sum() < 5
    assert int(np.unpackbits(bits).sum()) <= 500


def test_ids_go_to_the_most_frequent(spark):
    frequent = spark.createDataFrame([(f,) for f in [5] * 50 + [9] * 10 + [1000, 1001, 5000]], "f long")
    assert cl._ids_from(frequent, 5, 100) == (5, False)
    assert cl._ids_from(frequent, 5, 20) == (6, True)
    assert cl._ids_from(frequent, 5, 0) == (5001, True)
    assert cl._ids_from(frequent.filter("f < 0"), 5, 10) == (5, False)


def test_large_counts_are_exact(spark):
    """Products beyond 64 bits."""
    a, n = 3_000_000_000_000_007, 9_000_000_000_000_011
    frequent = spark.createDataFrame(
        [("en", "a b", a, 2), ("en", "a", a + 5, 1), ("en", "b", a + 9, 1)], "lang string, phrase string, f long, words int")
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    found = cl.rank_collocations(cl.Mined(frequent, totals, n)).first()
    assert found.score == 1000 * a * n // ((a + 5) * (a + 9))


def test_empty_tables_and_clashing_columns(spark):
    schema = "cell string, phrase int, LANG string, doc_id long, text string, f string"
    empty = spark.createDataFrame([], schema)
    assert cl.collocations(empty).count() == 0
    assert cl.collocations(spark.createDataFrame([("c", 1, None, 1, None, "f")], schema)).count() == 0
    docs = spark.createDataFrame([("c", 1, "en", 7, "a b", "f")] * 3, schema)
    assert [r.phrase for r in cl.collocations(docs, 3).collect()] == ["a b"]
    with pytest.raises(ValueError):
        cl.mine(docs, 0)


def test_one_very_long_text(spark):
    text = "one two three. " * 200_000 + "x" * 3_000_000
    docs = spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")
    found = {r.phrase: (r.a, r.l, r.r, r.n) for r in cl.collocations(docs).collect()}
    assert found == {"one two three": (200_000, 200_000, 200_000, 600_001)}
