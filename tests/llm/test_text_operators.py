"""BPE, secrets, language, decontamination, sharding and page text against brute force and on awkward rows."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from outlay.llm import bpe, decontamination, html, language, registry, secrets, sharding

LONG = "wort " * 30_000 + "x" * 5_000
AWKWARD = [(1, None), (2, ""), (3, "   \n"), (None, "a text without an id"), (4, "same"), (4, "same"), (5, LONG)]


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.load(registry.rank_file(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(tokenizer):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokenizer.ranks, special_tokens={}
    ).encode_ordinary


class TestBpe:
    def test_equals_the_library_on_random_texts(self, tokenizer, reference):
        rng = random.Random(3)
        for alphabet in ("thernioa", "abcdeth \n'é1.", "ä漢字🙂 ́a  ", " \t\r\n"):
            texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 700))) for _ in range(60)]
            values, bounds = tokenizer.encode(texts)
            for text, a, b in zip(texts, bounds, bounds[1:], strict=False):
                assert values[a:b].tolist() == reference(text)

    def test_long_pieces_and_a_full_memory(self, tokenizer, reference, monkeypatch):
        for text in ("ab" * 900, "a" * 3000, " " * 2000, "xyz" * 300 + "1" * 900):
            assert tokenizer.encode([text])[0].tolist() == reference(text)
        monkeypatch.setattr(bpe, "CACHE", 5)
        assert tokenizer.encode(["one two three four five six", "seven"])[0].tolist() == reference(
            "one two three four five six"
        ) + reference("seven")

    def test_digests_of_awkward_rows(self, documents, reference):
        df = bpe.digests(documents(*AWKWARD), registry.rank_file(), public_tokenizers.PATTERN)
        want = [
            (i, len(ids := reference(t or "")), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256((t or "").encode()).hexdigest()) for i, t in AWKWARD
        ]
        assert collections.Counter(map(tuple, df.collect())) == collections.Counter(want)
        empty = bpe.digests(documents((1, "x")).limit(0), registry.rank_file(), public_tokenizers.PATTERN)
        assert empty.count() == 0


def naive_spans(text):
    kinds = (
        ("assign", re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"""
                              r"""[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 1, 12),
        ("access", re.compile(r"(AKIA[A-Z0-9]+)"), 1, 18), ("hex", re.compile(r"([0-9a-f]+)"), 1, 16),
    )
    out = [
        (k, m.start(), m.end()) for k, p, g, least in kinds for m in p.finditer(text or "") if len(m.group(g)) >= least
    ]
    order = [k for k, *_ in kinds]
    return sorted(out, key=lambda s: (s[1], order.index(s[0])))


class TestSecrets:
    def test_base_spans_equal_the_definition(self):
        rng = random.Random(5)
        bits = ["password", "Token", "SECRET", "api_key", "apikey", "passwd", "=", ":", " = ", '"', "'", "AKIA", "AKIAABCDEFGHIJ1234", "é", " ",
                "0123456789abcdef", "deadbeef", "abcdefghijkl", "x-y_z", "\n", "K", "ſecret=abcdefghijklmnop"]
        for _ in range(3000):
            text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
            base = [s for s in secrets.spans_of(text) if s[0] in ("assign", "access", "hex")]
            assert base == naive_spans(text), text

    @pytest.mark.parametrize(("text", "kinds"), [
        ("user=alice and password: hunter2x", {"weak_access", "weak_secret"}),
        ("password: hunter2x alone", set()),
        ("user=alice alone, see https://example.org/a", set()),
        ("AKIAABCDEFGHIJ1234 wJalrXUtnFEMI/K7MDENG/bPxRfiCYzz0", {"access", "weak_secret"}),
        ("wJalrXUtnFEMI/K7MDENG/bPxRfiCYzz0 alone", set()),
        ("user=alice\n\npassword: hunter2x", set()),
        ("user=alice" + " pad" * 200 + " password: hunter2x", set()),
        ("postgres://db.example:5432/x user=bob password: hunter2x", {"endpoint", "weak_access", "weak_secret"}),
        ("see https://example.org/page", set()),
    ])
    def test_weak_parts_count_only_together(self, text, kinds):
        assert {k for k, *_ in secrets.spans_of(text)} == kinds

    @pytest.mark.parametrize("size", [20, 700, 800, 2000, 100_000])
    def test_opaque_tokens_of_any_length_on_either_side(self, size):
        token = ("aB3dE5gH7j" * (size // 10 + 1))[:size]
        for text in (f"client_id=foobar {token} end", f"start {token} client_id=foobar"):
            at = text.index(token)
            spans = secrets.spans_of(text)
            assert ("weak_secret", at, at + size) in spans and {k for k, *_ in spans} == {"weak_access", "weak_secret"}
            assert secrets.redact(text, spans) == text.replace(token, "[weak_secret]").replace("client_id=foobar", "[weak_access]")

    def test_links_equal_the_comparison_of_all_pairs(self):
        rng = random.Random(8)
        for _ in range(500):
            text = "".join(rng.choice("ab \n") for _ in range(60))
            spans = [(s, s + rng.randint(1, 12)) for s in (rng.randrange(50) for _ in range(rng.randint(0, 5)))]
            parts = secrets._Parts(text, 8, spans)
            for start in range(0, 50, 7):
                end = start + rng.randint(1, 9)
                gaps = [(end, s) if s >= end else (e, start) for s, e in spans if s >= end or e <= start]
                want = any(b - a <= 8 and not secrets.BLANK_LINE.search(text, a, b) for a, b in gaps)
                assert parts.link(start, end) == want
                assert parts.free(start, end) == all(s >= end or e <= start for s, e in spans)

    def test_digests_and_redaction(self, documents):
        rows = [*AWKWARD, (7, "é key AKIAABCDEFGHIJ1234, token=abcdefghijklmnop")]
        found = {(r.doc_id, r.spans) for r in secrets.digests(documents(*rows)).collect()}
        assert (7, "access:6:24,assign:26:48") in found and (1, "") in found and len(found) == 7
        texts = {r.doc_id: r.text for r in secrets.redact_secrets(documents(*rows)).collect()}
        assert texts[7] == "é key [access], [assign]" and texts[1] is None and texts[5] == LONG


class TestLanguage:
    TEXTS = {"en": "the cat and the dog are with the other one", "de": "der hund und die katze sind mit der anderen",
             "fr": "le chat et le chien sont avec les autres une"}

    def test_profiles_equal_a_naive_count(self, documents):
        rows = [(i, text, lang) for i, (lang, text) in enumerate(self.TEXTS.items())]
        model = language.learn(documents(*rows, (9, None, "xx"), (10, "no language", None)), 20)
        assert model.languages == ["de", "en", "fr"]
        for row, lang in enumerate(model.languages):
            count = collections.Counter()
            for word in self.TEXTS[lang].split():
                padded = f"\0{word}\0"
                for n in (1, 2, 3):
                    for i in range(len(padded) - n + 1):
                        gram = padded[i : i + n]
                        code = 0
                        for c in gram:
                            code = code << 21 | ord(c)
                        if gram.strip("\0") and not (n == 3 and gram[1] == "\0"):
                            count[code] += 1
            # between words the blank is shared, so blank-and-letter pairs are the same grams
            best = sorted(count, key=lambda g: (-count[g], g))[:20]
            own = {int(g): int(r) for g, r in zip(model.known, model.ranks[row], strict=False) if r >= 0}
            assert own == {g: i for i, g in enumerate(best)}

    def test_predictions_and_rejections(self, documents):
        docs = documents(*[(i, t, g) for i, (g, t) in enumerate(self.TEXTS.items())])
        model = language.learn(docs)
        rows = [(i, t.replace("cat", "cow"), "zz") for i, t in enumerate(self.TEXTS.values())]
        more = documents(*rows, *[(r[0] and r[0] + 10, r[1]) for r in AWKWARD], (30, "123 !!"))
        got = [(r.doc_id, r.lang_pred, r.score) for r in language.predict(more, model).collect()]
        by = {i: p for i, p, _ in got}
        assert [by[i] for i in range(3)] == list(self.TEXTS) and all(0 <= s <= 1 for *_, s in got)
        assert by[11] == by[12] == by[13] == by[30] == "und" and len(got) == more.count()
        kept = language.keep_identified(more, model)
        assert kept.columns == more.columns and {11, 12, 13, 30}.isdisjoint(r.doc_id for r in kept.collect())
        nothing = language.learn(docs.limit(0))
        assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}

    def test_held_out_fold(self, spark):
        rows = spark.range(50).select("id", language.held_out(F.col("id"), 4).alias("h")).collect()
        assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


class TestDecontamination:
    ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"

    def test_any_two_of_thirteen_words_may_differ(self):
        bench = decontamination.Benchmark([(1, " ".join(self.ITEM.split()[:13]))])
        words = self.ITEM.split()[:13]
        for places in itertools.combinations(range(1, 12), 2):
            text = " ".join("other" if i in places else w for i, w in enumerate(words))
            assert bench.overlaps([f"before it {text} after"], 13, 0.8), places

    @pytest.mark.parametrize("n", [*range(5, 17), 20, 21, 25])
    def test_every_substitution_within_the_similarity_is_found(self, n):
        words = [f"w{i}" for i in range(n)]
        bench, most = decontamination.Benchmark([(1, " ".join(words))]), (n * 10 - n * 8) // 10
        rng = random.Random(n)
        every = list(itertools.combinations(range(n), most))
        places = rng.sample(every, min(len(every), 500))
        if n == 20:  # these were missed by the first four masks
            places += [c for c in every if not any(
                all(not (x == "1" and at + i in c) for i, x in enumerate(m)) for m in decontamination.MASKS[:4] for at in range(n - len(m) + 1)
            )]
        for changed in places:
            text = " ".join("other" if i in changed else w for i, w in enumerate(words))
            found = bench.overlaps([f"before {text} after"], 13, 0.8)
            inner = not changed or (changed[0] > 0 and changed[-1] < n - 1)
            assert found and (n > 12 or found[0][2:] == (1, n, n - most)) and (not inner or found[0][4] == n - most), changed
        if n < 13:
            text = " ".join("other" if i <= most else w for i, w in enumerate(words))
            assert not bench.overlaps([text], 13, 0.8)

    @pytest.mark.parametrize("item", [
        "人工智能模型的训练数据必须去除评测题目", "この文章は評価のために作られたものです", "ภาษาไทยไม่มีช่องว่างระหว่างคำ",
    ])
    def test_scripts_without_blanks_are_cut_into_characters(self, item):
        bench = decontamination.Benchmark([(1, item), (2, "x")])
        near = item[:6] + "新" + item[7:]
        for text, same in ((f"见{item}。", len(item)), (f"见{near}。", len(item) - 1)):
            assert bench.overlaps([text, "别的内容完全不同", None], 13, 0.8) == [(0, 0, 1, len(item), same)]
        assert decontamination.words_of("Ab人工 été, x") == ["ab".encode(), "人".encode(), "工".encode(), "été".encode(), b"x"]

    def test_overlaps_of_rows(self, documents, stored):
        items = [(1, self.ITEM), (2, None), (3, "too short here"), (4, "a short item of seven words only"), (5, self.ITEM)]
        bench = stored(items, "item_id long, text string")
        words = self.ITEM.upper().replace(" ", ", ")
        near = self.ITEM.replace("seven", "7").replace("twelve", "12")
        far = " ".join(w if i % 3 else "no" for i, w in enumerate(self.ITEM.split()))
        rows = [*AWKWARD, (20, f"x {words}."), (21, f"y y {near} z"), (22, far), (23, "we saw a short item of seven words only here"),
                (24, " ".join(self.ITEM.split()[:9])), (25, "too short here")]
        found = decontamination.find_overlaps(documents(*rows), bench)
        got = sorted((r.doc_id, r.item_id, r.first_word, r.n_words, r.n_equal) for r in found.collect())
        assert got == [(20, 1, 1, 15, 15), (20, 5, 1, 15, 15), (21, 1, 2, 15, 13), (21, 5, 2, 15, 13), (23, 4, 2, 7, 7)]
        blocks = decontamination.find_overlaps(documents(*rows), bench, block_bytes=40)
        assert sorted((r.doc_id, r.item_id, r.first_word, r.n_words, r.n_equal) for r in blocks.collect()) == got
        clean = decontamination.decontaminate(documents(*rows), bench)
        assert clean.count() == len(rows) - 3 and {20, 21, 23}.isdisjoint(r.doc_id for r in clean.collect())
        assert decontamination.find_overlaps(documents(*rows), bench.limit(0)).count() == 0


class TestSharding:
    def test_every_row_once_in_shards_of_equal_counts(self, clashing):
        rows = [*AWKWARD, *[(i, f"text {i}") for i in range(100, 230)]]
        out = sharding.external_shuffle(clashing(*rows), 7, bucket_bytes=3000)
        got = out.collect()
        assert collections.Counter((r.doc_id, r.text) for r in got) == collections.Counter(rows)
        by = collections.defaultdict(list)
        for r in got:
            by[r.shard].append(r.slot)
        sizes = [len(s) for s in by.values()]
        assert set(by) == set(range(7)) and max(sizes) - min(sizes) <= 1
        assert all(sorted(s) == list(range(len(s))) for s in by.values())

    def test_order_is_random_and_repeatable(self, documents):
        docs = documents(*[(i, "t" * (i % 50)) for i in range(400)])
        order = [[r.doc_id for r in sorted(sharding.external_shuffle(docs, 1, s, 5000).collect(), key=lambda r: r.slot)] for s in (1, 1, 2)]
        assert order[0] == order[1] != order[2]
        steps = np.abs(np.diff(order[0]))
        assert steps.mean() > 80

    def test_written_shards_and_empty_tables(self, spark, documents, tmp_path):
        docs = documents(*[(i, "t") for i in range(50)])
        sharding.write_shards(sharding.external_shuffle(docs, 3), str(tmp_path / "out"))
        assert spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().count() == 3
        assert sharding.digests(docs.limit(0), 16).count() == 0
        row = sharding.digests(documents((1, None)), 16).first()
        assert (row.size, row.text_crc32, row.law, row.shard, row.slot, row.grown_shard) == (1, 0, "rows", 0, 0, None)


PAGE = """<!DOCTYPE html><html><head><title>No</title><script>var t="</p>";</script><style>p{}</style></head><body>
<nav><ul><li><a href="/x">menu one</a></li><li>menu two</li></ul></nav><!-- <p>comment</p> --><div class="ad">buy this now please do</div>
<article><h1>Title &amp; more</h1><p><b>First  part.<br><p>Second
 part <i>goes</i> on &lt;here&gt;.</p><div class="comments"><p>reader says</p></div><form>name <input></form><p>Et.</p></article>
<footer>&copy; footer words that are many and long</footer></body></html>"""
WANT = "Title & more\nFirst part.\nSecond part goes on <here>.\nEt."


class TestPages:
    def test_content_only(self, stored):
        rows = [(1, "u", PAGE), (2, "u", PAGE), (3, None, None), (4, "u", ""), (5, "u", "plain words"), (None, "u", "<p>unclosed <b"),
                (6, "u", "<div><p>" + "word " * 50_000)]
        pages = stored(rows, "page_id long, url string, html string")
        got = {r.page_id: (r.text, r.n_chars) for r in html.digests(pages).collect()}
        assert got[1] == got[2] == (WANT, len(WANT)) and got[3] == got[4] == ("", 0)
        assert got[5] == ("plain words", 11) and got[None] == ("unclosed", 8) and got[6][1] == 5 * 50_000 - 1
        assert html.digests(pages.limit(0)).count() == 0

    def test_one_outlier_page_leaves_the_other_texts(self, stored):
        def page(k):
            parts = "".join(f"<p>part {i} of page {k} has some words of its own</p>" for i in range(4))
            around = "<div><p>short line outside</p></div>" if k % 10 == 0 else "<div>six words that stand before it</div>"
            return f"<html><body>{around}<article>{parts}</article></body></html>"

        rows = [(k, "u", page(k)) for k in range(40)]
        outlier = (99, "u", "<html><body><div>" + "legal " * 10_000 + "</div><article><p>small text</p></article></body></html>")
        texts = []
        for given in (rows, [*rows, outlier]):
            found = html.digests(stored(given, "page_id long, url string, html string")).collect()
            texts.append({r.page_id: r.text for r in found if r.page_id != 99})
        want = {k: "\n".join(f"part {i} of page {k} has some words of its own" for i in range(4)) for k in range(40)}
        assert texts[0] == want and texts[1] == want

    def test_region_is_the_best_of_all(self):
        rng = random.Random(1)
        for _ in range(300):
            value = [rng.choice([1.0, 2.0, 3.0, -0.5, -3.0, -0.25, 0.0]) for _ in range(rng.randint(0, 12))]
            best = max((sum(value[a:b]) for a in range(len(value)) for b in range(a + 1, len(value) + 1)), default=0)
            a, b = html.region(np.array(value))
            assert sum(value[a:b]) == max(best, 0)

    LEARNED = [PAGE] * 3

    @pytest.mark.parametrize("page", [
        '<body><div class="layout with-sidebar"><article><p>kept text of the page</p></article></div></body>',
        '<body><div class="content no-sidebar"><article><p>kept text of the page</p></article></div></body>',
        '<body><div class="ad-free"><p>kept text of the page</p></div></body>',
        '<body><div data-id="comments"><article><p>kept text of the page</p></article></div></body>',
        '<body><p class="ad">x<div><article><p>kept text of the page</p></article></div></body>',
        '<body><p><span class="share">x</p><article><p>kept text of the page</p></article></body>',
        '<body><div class="sidebar"><article><p>kept text of the page</p></article></div></body>',
        '<body><div class=ads>buy</div><article class="article-header"><p>kept text of the page</p></article></body>',
        '<body><article><header class="article-header">kept text</header><p hidden>of the page</p></article></body>',
        '<body><article><p>kept text</p><div class="ad">buy this thing now</div><p>of the page</p></article><footer>x y z</footer></body>',
        '<body><article><p>kept text<p>of the page<section id="comments"><p>reader one<p>reader two</section></article></body>',
        '<body><article><ul><li>kept text<li>of the page</ul><aside>by the way</aside></article></body>',
    ])
    def test_names_take_nothing_from_the_content(self, stored, page):
        pages = stored([(i, "u", p) for i, p in enumerate([*self.LEARNED, page])], "page_id long, url string, html string")
        found = {r.page_id: r.text for r in html.digests(pages).collect()}
        assert found[3].replace("\n", " ") == "kept text of the page" and found[0] == WANT

    def test_names_are_learned(self, stored):
        """A made-up class that stands outside the content on labelled pages is dropped inside it and on pages without a mark."""
        def page(k, inside=""):
            return f'<body><div class="zq-rail other{k}">see also page {k}</div><article><p>text of page {k}</p>{inside}<p>goes on</p></article></body>'

        rows = [(k, "u", page(k)) for k in range(6)] + [
            (6, "u", page(6, '<div class="zq-rail">see this instead</div>')),
            (7, "u", '<body><p>unmarked page with some words</p><div class="zq-rail">see that</div><p>and more words</p></body>'),
        ]
        pages = stored(rows, "page_id long, url string, html string")
        weights = html.learn_weights(pages)
        assert "zq-rail" in weights.names and "other1" not in weights.names
        found = {r.page_id: r.text for r in html.extract(pages, weights).collect()}
        assert found[6] == "text of page 6\ngoes on" and found[7] == "unmarked page with some words\nand more words"
        nothing = html.extract(pages, html.Weights({"": 0.0}, lists=False)).collect()
        assert all(r.text != found[r.page_id] for r in nothing)
