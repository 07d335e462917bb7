"""Lattice scores, near-duplicates, vectors, repeated passages and the pipeline against brute force and on awkward rows."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import os
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from outlay.llm import euclid, grouping, jaccard, language, lattice, registry, substrings, tables
from outlay.llm.tables import Store

FOLDER = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}" for i in range(20_000))


def words(rng, n, kinds=400):
    return [f"v{rng.randint(0, kinds)}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    """Texts with exact and near copies, shared passages, loops, nulls, short texts, null ids and repeated rows."""
    rng = random.Random(11)
    rows = [(i, " ".join(words(rng, rng.randint(25, 90)))) for i in range(40)]
    for i in range(40, 90):  # near copies in a large group and in small ones
        base = rows[0 if i < 75 else rng.randint(1, 5)][1].split()
        for _ in range(rng.randint(0, 3)):
            base[rng.randrange(len(base))] = "edit"
        rows.append((i, " ".join(base)))
    passage = " ".join(words(rng, 30))
    rows += [(i, f"{' '.join(words(rng, 10))} {passage} {' '.join(words(rng, 10))}") for i in range(100, 112)]
    rows += [(120, "loop one two three " * 30), (121, None), (122, ""), (123, "two words"), (124, "two  words"), (None, rows[3][1]),
             (None, None), (125, LONG), (126, LONG), (5, rows[5][1])]
    return rows


class TestJaccard:
    def test_equals_all_pairs(self, documents, corpus):
        docs = documents(*corpus)
        numbered = tables.numbered(docs, Store(docs.sparkSession, "expected")).select("row", "doc_id", "text").collect()
        sets = {}
        for r in numbered:
            w = (r.text or "").lower().split()
            n = min(5, len(w))
            sets[r.row] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
        links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
        forest = {r: r for r in sets}

        def root(r):
            while forest[r] != r:
                r = forest[r]
            return r

        count = collections.Counter(itertools.chain.from_iterable(links))
        for a, b in links:
            forest[root(b)] = root(a)
        order = {r.row: (r.doc_id is None, r.doc_id or 0, r.row) for r in numbered}
        ids = {r.row: r.doc_id for r in numbered}
        head = {}
        for r in sets:
            head[root(r)] = min(head.get(root(r), order[r]), order[r])
        want = {r: (ids[r], ids[head[root(r)][2]], count[r], order[r] == head[root(r)]) for r in sets}
        for block in (512, 8):
            got = {r.row: (r.doc_id, r.class_id, r.n_links, r.kept) for r in jaccard.near_duplicates(docs, block=block).collect()}
            assert got == want
        kept = jaccard.keep_first_of_class(docs)
        assert kept.columns == docs.columns and kept.count() == sum(w[3] for w in want.values())

    def test_depth_reaches_the_recall(self):
        depth = jaccard.matched_depth()
        assert 1 - (1 - 0.8**depth) ** jaccard.TREES >= jaccard.RECALL > 1 - (1 - 0.8 ** (depth + 1)) ** jaccard.TREES

    def test_no_rows(self, documents):
        assert jaccard.near_duplicates(documents((1, "a")).limit(0)).count() == 0
        row = jaccard.near_duplicates(documents((1, None))).first()
        assert (row.class_id, row.n_links, row.kept) == (1, 0, True)


class TestComponents:
    def test_equals_union_find(self, spark):
        rng = random.Random(2)
        edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randint(100, 400), rng.randint(100, 400)) for _ in range(180)]
        edges += [(1000, i) for i in range(900, 990)]
        forest = {}

        def root(x):
            forest.setdefault(x, x)
            while forest[x] != x:
                x = forest[x]
            return x

        for a, b in edges:
            low, high = sorted((root(a), root(b)))
            forest[high] = low
        df = spark.createDataFrame(edges, "a long, b long")
        got = {r.node: r.component for r in grouping.components(df, Store(spark, "test"), "c").collect()}
        loops = {a for a, b in edges if a == b}
        assert {n: c for n, c in got.items()} == {n: root(n) for n in forest if n in got} and set(forest) - set(got) <= loops


class TestVectors:
    def build(self, stored):
        rng = np.random.default_rng(4)
        rows = []
        for g in range(30):
            centre = rng.normal(size=16)
            for _ in range(12 if g == 0 else rng.integers(1, 5)):
                rows.append((len(rows), (centre + rng.normal(size=16) * 0.08).astype(np.float32).tolist(), 0))
        rows += [(len(rows) + i, rows[0][1], 0) for i in range(3)]
        n = len(rows)
        bad = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0] * 3, [2.0] * 3]
        rows += [(n + i, v, 1) for i, v in enumerate(bad)]
        return rows, stored(rows, "vec_id long, embedding array<float>, label int")

    @pytest.mark.parametrize("block", [512, 4])
    def test_equals_all_pairs(self, stored, block):
        rows, table = self.build(stored)
        unit = {i: euclid.normalised(v) for i, v, _ in rows}
        links = [
            (a, b) for a, b in itertools.combinations(unit, 2)
            if unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95
        ]
        assert len(links) > 60
        count = collections.Counter(itertools.chain.from_iterable(links))
        root = {i: i for i in unit}
        for _ in range(40):
            for a, b in links:
                root[a] = root[b] = min(root[a], root[b])
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in euclid.near_duplicates(table, block=block).collect()}
        assert got == {i: (count[i], root[i], root[i] == i) for i in unit}

    def test_shape_and_no_rows(self, stored):
        k, tables = euclid.shape(50_000)
        assert 1 - (1 - euclid.step_probability(math.sqrt(0.1), euclid.WIDTH) ** k) ** tables >= euclid.RECALL
        assert euclid.near_duplicates(stored([(1, [1.0], 0)], "vec_id long, embedding array<float>, label int").limit(0)).count() == 0


def kept_words(rows, window=20):
    seen, out = set(), {}
    for place, (doc_id, text) in sorted(enumerate(rows), key=lambda r: (r[1][0] is None, r[1][0] or 0, r[0])):
        w = (text or "").encode().split()
        stays = [True] * len(w)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if key in seen:
                stays[i : i + window] = [False] * window
            seen.add(key)
        out[place] = (doc_id, len(w), len(w) - sum(stays), b" ".join(x for x, s in zip(w, stays, strict=True) if s))
    return out


class TestSubstrings:
    @pytest.mark.parametrize(("chunk", "group", "long_word"), [(2_000_000, 8 << 20, 64), (50, 300, 3), (50, 0, 64)])
    def test_equals_a_scan_of_all_windows(self, documents, corpus, chunk, group, long_word, monkeypatch):
        monkeypatch.setattr(substrings, "CHUNK", chunk)
        monkeypatch.setattr(substrings, "GROUP_BYTES", group)
        monkeypatch.setattr(substrings, "LONG_WORD", long_word)
        docs = documents(*corpus)
        in_order = [(r.doc_id, r.text) for r in docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row")).orderBy("row").collect()]
        want = collections.Counter((d, n, k, hashlib.sha256(t).hexdigest()) for d, n, k, t in kept_words(in_order).values())
        assert sum(k for _, _, k, _ in want) > 500
        assert collections.Counter(map(tuple, substrings.digests(docs).collect())) == want

    def test_words_are_compared_not_their_hashes(self, documents, monkeypatch):
        """With one hash for all words every window looks alike; results stay the same."""
        monkeypatch.setattr(substrings, "word_hashes", lambda words: np.zeros(len(words), np.uint64))
        rng = random.Random(5)
        shared = words(rng, 30)
        rows = [(i, " ".join([*words(rng, 15), *(shared if i % 2 else []), *words(rng, 15)])) for i in range(12)]
        want = {(d, n, k, hashlib.sha256(t).hexdigest()) for d, n, k, t in kept_words(rows).values()}
        assert sum(k for _, _, k, _ in want) >= 150
        assert set(map(tuple, substrings.digests(documents(*rows)).collect())) == want

    def test_rounds_share_out_the_suffixes(self, spark):
        rng = random.Random(7)
        runs = spark.createDataFrame([(i, i, " ".join(words(rng, 20 + i)), 3 * i) for i in range(40)], "row long, doc_id long, words string, start int")
        whole = collections.Counter(map(tuple, substrings._expanded(runs, 20).collect()))
        want = [(" ".join(r.words.split()[k : k + 20]), r.doc_id, r.row, r.start + k) for r in runs.collect() for k in range(r.row + 1)]
        assert whole == collections.Counter(want)
        parts = [collections.Counter(map(tuple, substrings._expanded(runs, 20, 3, k).collect())) for k in range(3)]
        assert all(parts) and sum(parts, collections.Counter()) == whole

    def test_crowded_prefixes_grow_until_their_group_fits(self, spark, monkeypatch):
        """One prefix of 9 words holds a third of all suffixes: its subtrees fit all the same, and no suffix changes."""
        monkeypatch.setattr(substrings, "GROUP_BYTES", 2000)
        rng = random.Random(6)
        form = [f"form{i}" for i in range(9)]
        texts = [" ".join([*form, *words(rng, 11)]) for _ in range(300)] + [" ".join(words(rng, 20)) for _ in range(600)]
        suffixes = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "words string, row long")
        placed = substrings.subtrees(suffixes, substrings.crowded_prefixes(suffixes, Store(spark, "subtrees"), 20), 20).collect()
        assert sorted((r.words, r.row) for r in placed) == sorted((t, i) for i, t in enumerate(texts))
        sizes, depths = collections.Counter(), collections.defaultdict(set)
        for r in placed:
            prefix = tuple(r.words.split()[: r.depth])
            sizes[prefix] += len(r.words)
            depths[r.words.startswith("form0")].add(r.depth)
        assert max(sizes.values()) <= 2000
        assert depths == {True: {12}, False: {4}}
        assert not any(a != b and a == b[: len(a)] for a in sizes for b in sizes)

    def test_no_rows(self, documents):
        assert substrings.digests(documents((1, "a")).limit(0)).count() == 0

    def test_equal_windows_have_equal_anchors(self):
        rng = np.random.default_rng(0)
        for high in (3, 2**60):
            runs = rng.integers(0, high, 300, dtype=np.uint64)
            places = substrings.anchor_places(runs, 20, 8)
            assert all(p == i + int(np.argmin(runs[i : i + 13])) for i, p in enumerate(places))


class TestLattice:
    @pytest.fixture(scope="class")
    def pieces(self):
        return lattice.Pieces.from_ranks(registry.rank_file())

    def brute(self, pieces, word):
        text = b" " + word
        found = {}
        for i, j in itertools.combinations(range(len(text) + 1), 2):
            raw = np.frombuffer(text[i:j], np.uint8).astype(np.uint64)[None, :]
            code = lattice._mixed(lattice._prefix_hashes(raw)[:, -1], j - i)[0]
            at = int(np.searchsorted(pieces.hashes, code))
            if at < len(pieces.hashes) and pieces.hashes[at] == code:
                found[i, j] = at
        total, uses = 0.0, collections.Counter()

        def walk(i, weight, used):
            nonlocal total
            if i == len(text):
                total += weight
                for u in used:
                    uses[u] += weight
            for j in range(i + 1, len(text) + 1):
                if (i, j) in found:
                    walk(j, weight * math.exp(pieces.scores[found[i, j]]), [*used, found[i, j]])

        walk(0, 1.0, [])
        return math.log(total) + pieces.stop, {u: v / total for u, v in uses.items()}

    def test_recursion_equals_all_segmentations(self, pieces):
        for word in (b"the", b"thntdle", "être".encode(), b"x9!!", b"q"):
            marginal, uses = self.brute(pieces, word)
            assert pieces.marginals([word])[0, 0] == pytest.approx(marginal)
            expected = pieces.expected([word], np.array([[2.0]]))[0]
            assert {int(i): v for i, v in enumerate(expected) if v > 1e-12} == pytest.approx({u: 2 * v for u, v in uses.items() if v > 5e-13})

    def test_scores_of_rows(self, documents):
        rng = random.Random(8)
        rows = [(i, " ".join(words(rng, rng.randint(5, 40), 60)), "en" if i % 2 else "de") for i in range(60)]
        rows += [(100, None), (101, ""), (102, "New words\tHERE"), (102, "New words\tHERE"), (None, "v1 v2", None), (103, "x" * 3000)]
        docs = documents(*rows)
        out = language.held_out(F.col("doc_id"), 7)
        held = {r.doc_id for r in docs.filter(out).collect()}
        trained = [r for r in rows if r[0] not in held]
        count = collections.Counter()
        for r in trained:
            count.update((r[1] or "").lower().split())
            count[None] += 1
        total, distinct = sum(count.values()), len(count)
        for heavy in (1e-6, 0.05):
            got = lattice.score_texts(docs, ~out, registry.rank_file(), heavy=heavy).collect()
            assert len(got) == len(rows)
            texts = collections.defaultdict(list)
            for r in rows:
                texts[r[0]].append(r[1])
            for r in got:
                tokens = [*(texts[r.doc_id][0] or "").lower().split(), None]
                base = sum(math.log10((count[t] + 1) / (total + distinct + 1)) for t in tokens)
                assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(count[t] > 0 for t in tokens), total)
                assert r.base_score == pytest.approx(base) and -1e5 < r.score <= 0
            scores = collections.defaultdict(set)
            for r in got:
                scores[heavy].add((r.doc_id, round(r.score, 6)))
        nothing = lattice.score_texts(docs.limit(5), F.lit(False), registry.rank_file()).collect()
        assert len(nothing) == 5 and all(r.train_tokens == 0 and r.n_known == 0 for r in nothing)
        assert lattice.score_texts(docs.limit(0), ~out, registry.rank_file()).count() == 0

    def test_scores_are_sums_over_the_classes_whatever_is_heavy(self, documents, monkeypatch):
        rng = random.Random(9)
        rows = [(i, " ".join([*["shared"] * 8, *(f"{lang}{rng.randint(0, 40)}" for _ in range(6))]), lang)
                for i, lang in enumerate(["en"] * 30 + ["de"] * 30 + ["fr"] * 6)]
        docs = documents(*rows, (200, "shared fr1 fr2 fr3 de1"), (201, None), (202, "never seen words"))
        held, out = F.col("doc_id") >= 200, []
        parts, inner = {}, lattice._score_heavy

        def spy(*given):
            heads = inner(*given)
            parts.update({(r.doc_id, len(r.rare)): [r[n] for n in heads.columns if n.startswith("score")] for r in heads.collect()})
            return heads

        monkeypatch.setattr(lattice, "_score_heavy", spy)
        for heavy in (1e-6, 0.05, 0.9):
            got = lattice.score_texts(docs, ~held, registry.rank_file(), heavy=heavy).collect()
            out.append({r.doc_id: r.score for r in got})
        assert out[1] == pytest.approx(out[0], abs=1e-6) and out[2] == pytest.approx(out[0], abs=1e-6)
        for (i, rare), by_class in parts.items():
            if not rare:  # all words are heavy, so these are whole sums
                assert len(by_class) == 3 and out[0][i] == pytest.approx(np.logaddexp.reduce(np.array(by_class) * math.log(10)) / math.log(10))

    def test_probabilities_of_a_class_sum_to_one(self, pieces):
        totals = lattice.Totals(tokens=10, distinct=4, ends=2)
        c = np.array([5.0, 2.0, 1.0])
        seen = pieces.marginals([b"the", b"of", b"to"])[:, 0]
        listed = 10 ** totals.score(c, seen)
        rest = totals.distinct / (totals.tokens + totals.distinct) * (1 - np.exp(seen).sum())
        assert listed.sum() + rest + 10**totals.end_score == pytest.approx(1)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
class TestPipeline:
    def test_stages_compose(self, spark):
        docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
        assert [name for name, _ in corpus_pipeline.STAGES] == [
            "language_id", "ngram_jaccard_join", "benchmark_decontamination", "secret_scan", "byte_bpe"]
        store = Store(spark, "test-pipeline")
        frames = [docs]
        for name, stage in corpus_pipeline.STAGES:
            frames.append(store.put(name, stage(spark, frames[-1], FOLDER)))
        counts = [f.count() for f in frames]
        assert counts == sorted(counts, reverse=True) and counts[-1] == counts[-3] == counts[-2] > 0.5 * counts[0]
        assert all(set(f.columns) == set(docs.columns) for f in frames[:-1])
        run = corpus_pipeline.run(spark, FOLDER)
        assert sorted(map(tuple, run.collect())) == sorted(map(tuple, frames[-1].collect()))
        texts = {r.doc_id: r.text for r in frames[-2].collect()}
        assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in frames[-1].collect())

    @pytest.mark.parametrize("name", sorted(registry.all_queries()))
    def test_query_runs(self, spark, name):
        table = {"op6": "pages", "op9": "embeddings"}.get(name.split("_")[0], "documents")
        rows = registry.all_queries()[name](spark, FOLDER).count()
        assert rows > 0 if name.startswith("op3") else name.startswith("op13") or rows == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.all_oracles()))
def test_query_equals_its_counterpart(spark, name):
    db = pytest.importorskip("duckdb").connect()
    for table in ("documents", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = registry.all_queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    other = db.execute(f"SELECT {', '.join(columns)} FROM ({registry.all_oracles()[name]})").fetchall()
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(other)


def test_rank_file_is_the_public_one():
    with open(public_tokenizers.path(registry.RANK_FILE), "rb") as file:
        assert file.read() == registry.rank_file()
