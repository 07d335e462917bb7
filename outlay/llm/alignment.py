"""Alignment of two tokenizers: which tokens of one cover the same bytes as which of the other, and how often.

Both tokenizers encode a blank and the text. Byte offsets where a token of each ends cut the tokens into groups. Two tokens are linked where their
bytes overlap; an id pair's count is the number of documents that hold it linked, one at most for each document.

* Encoding happens once: the ids are stored as two bytes each, and the two passes after it only add up token lengths.
* Identity map: an array gives for each A id the B id with the same bytes. A group of one A and one B token that the array maps onto each other
  is exact. Exact pairs are counted in a vector with a place for each A id; a task passes on one vector.
* Only the other pairs, from irregular groups, are counted by pair: summed in the task, then by a shuffle of (pair, documents).
* Scoring: the counts of exact pairs, each A id's highest count, and the pairs with ``SHARE`` of all irregular (document, pair) links, so a million at
  most whatever the corpus, go to all tasks. Links of rarer pairs meet their counts in a shuffle by pair, where no pair can be hot, and are summed by document.

A text has no tokens, and zeros in all columns, if it is null or empty or if either tokenizer's bytes are not those of the blank and the text (B may
normalise). Long texts are cut before single blanks, where neither tokenizer joins anything, so memory follows ``CHUNK`` and the longest stretch without
such a blank. Rows are numbered in the stored table, so ids may be null or repeat: each row counts as a document. An empty table gives an empty
result. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outlay.llm.tables import Store, Tally, pick, slices

SHARE = 1e-6
CHUNK = 1 << 18
SLICE = 1 << 20
SPARSE = 1_000_000
B_BITS = 16
ENCODED = "doc_id long, a binary, b binary"
SCORED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, "
    "rare array<struct<pair: long, links: long>>"
)
# A blank between two characters that are no white space: no token of either kind crosses its left side.
BORDER = re.compile(r"(?<=\S) (?=\S)")


def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    found = {chr(b): b for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in set(plain)):
        found[chr(0x100 + n)] = b
    return found


def a_token_bytes(vocabulary_file: bytes) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary; tokens added to it are text as it stands."""
    described = json.loads(vocabulary_file)
    alphabet = _byte_alphabet()
    added = {t["id"]: t["content"].encode() for t in described.get("added_tokens", [])}
    vocabulary = described["model"]["vocab"]
    found = [b""] * (max([*vocabulary.values(), *added]) + 1)
    for entry, token in vocabulary.items():
        found[token] = added[token] if token in added else bytes(alphabet[c] for c in entry)
    for token, content in added.items():
        found[token] = content
    return found


def a_encoder(vocabulary_file: bytes, pattern: str) -> Callable[[str], np.ndarray]:
    """Text to ids, special tokens being text. Where ids are numbered in the order of the merges, a rank encoder gives the same ids sooner."""
    described = json.loads(vocabulary_file)
    model = described["model"]
    vocabulary = model["vocab"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    splits = described.get("pre_tokenizer") or {}
    plain = (
        not described.get("normalizer") and not model.get("ignore_merges") and not model.get("dropout")
        and splits.get("type") == "ByteLevel" and splits.get("use_regex") and not splits.get("add_prefix_space")
    )
    if plain and all(vocabulary[left + right] == 256 + i for i, (left, right) in enumerate(merges)):
        import tiktoken

        added = {t["id"] for t in described.get("added_tokens", [])}
        ranks = {content: i for i, content in enumerate(a_token_bytes(vocabulary_file)) if i not in added}
        encoder = tiktoken.Encoding("aligned", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return lambda text: encoder.encode_to_numpy(text, disallowed_special=())
    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(vocabulary_file.decode())
    whole.encode_special_tokens = True
    return lambda text: np.array(whole.encode(text, add_special_tokens=False).ids, np.int64)


def b_token_bytes(pieces: list[str]) -> list[bytes]:
    """The bytes of each piece: U+2581 is a blank, <0xHH> a byte."""
    return [
        bytes([int(p[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces
    ]


def identity_map(a_bytes: list[bytes], b_bytes: list[bytes]) -> np.ndarray:
    """For each A id the B id with the same bytes, a whole piece rather than a byte; -1 where there is none."""
    place: dict[bytes, int] = {}
    for token, content in enumerate(b_bytes):
        place[content] = token  # whole pieces come after the bytes
    return np.array([place.get(content, -1) for content in a_bytes], np.int64)


@dataclass
class Vocabularies:
    """What tasks need of the two vocabularies: bytes in each token, the identity map, and ids as text."""

    a_lengths: np.ndarray
    b_lengths: np.ndarray
    same: np.ndarray

    @staticmethod
    def of(a_file: bytes, b_file: bytes) -> Vocabularies:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        a_bytes = a_token_bytes(a_file)
        b_bytes = b_token_bytes([model.id_to_piece(i) for i in range(model.get_piece_size())])
        if max(len(a_bytes), len(b_bytes)) > 1 << B_BITS:
            raise ValueError("ids must fit into two bytes")
        if not all(a_bytes) or not all(b_bytes):
            raise ValueError("a token without bytes")
        lengths = [np.array([len(t) for t in side], np.int64) for side in (a_bytes, b_bytes)]
        return Vocabularies(*lengths, identity_map(a_bytes, b_bytes))


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """The text in parts of about ``size`` characters, each but the first beginning with a single blank."""
    start = 0
    while len(text) - start > size:
        border = BORDER.search(text, start + size)
        if border is None:
            break
        yield text[start : border.start()]
        start = border.start()
    yield text[start:]


def _encode(files, pattern: str):
    """The stored ids of both tokenizers; none where a text has no tokens."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        a_file, b_file = files.value
        a_ids = a_encoder(a_file, pattern)
        b_model = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        a_lengths = np.array([len(t) for t in a_token_bytes(a_file)])
        b_bytes = b_token_bytes([b_model.id_to_piece(i) for i in range(b_model.get_piece_size())])

        def ids(text: str) -> tuple[bytes, bytes]:
            if not text:
                return b"", b""
            whole = " " + text
            parts = [whole] if len(whole) <= CHUNK else list(chunks(whole))
            content = whole.encode()
            b = [token for found in b_model.encode([p[1:] for p in parts], num_threads=1) for token in found]
            if b"".join(map(b_bytes.__getitem__, b)) != content:
                return b"", b""
            a = np.concatenate([a_ids(p) for p in parts])
            # Tokens of a byte-level vocabulary are the text's own bytes, so their number tells whether all are there.
            if a_lengths[a].sum() != len(content):
                return b"", b""
            return a.astype("<u2").tobytes(), np.array(b, "<u2").tobytes()

        for batch in slices(batches, limit=SLICE):
            a_side, b_side = zip(*[ids(t or "") for t in batch.column(1).to_pylist()], strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(a_side, pa.binary()), pa.array(b_side, pa.binary())], ["doc_id", "a", "b"],
            )

    return run


class Aligned:
    """The groups and links of some documents, whose tokens stand one after the other."""

    def __init__(self, vocabularies: Vocabularies, a_side: list[bytes], b_side: list[bytes]):
        self.n_a = np.array([len(x) // 2 for x in a_side], np.int64)
        self.n_b = np.array([len(x) // 2 for x in b_side], np.int64)
        self.a = np.frombuffer(b"".join(a_side), "<u2").astype(np.int64)
        self.b = np.frombuffer(b"".join(b_side), "<u2").astype(np.int64)
        self.a_doc = np.repeat(np.arange(len(a_side)), self.n_a)
        # Both sides have the same bytes in each document, so documents end where groups end.
        a_ends, b_ends = np.cumsum(vocabularies.a_lengths[self.a]), np.cumsum(vocabularies.b_lengths[self.b])
        at = np.searchsorted(b_ends, a_ends)  # the B token that holds an A token's last byte
        self.a_last = b_ends[at] == a_ends
        self.b_last = np.zeros(len(self.b), bool)
        self.b_last[at[self.a_last]] = True
        self.a_group = np.cumsum(self.a_last) - self.a_last
        self.b_group = np.cumsum(self.b_last) - self.b_last
        past = at + self.a_last
        self.first = np.concatenate([[0], past[:-1]])[: len(at)]  # the B token that holds the first byte
        self.links = at + 1 - self.first
        opens = np.concatenate([[True], self.a_last[:-1]])[: len(at)]
        alone = self.a_last & opens & (self.links == 1)
        self.same = vocabularies.same
        self.exact = alone & (self.same[self.a] == self.b[self.first]) if len(at) else alone

    def n_links(self) -> np.ndarray:
        return np.bincount(self.a_doc, weights=self.links, minlength=len(self.n_a)).astype(np.int64)

    def n_groups(self) -> np.ndarray:
        return np.bincount(self.a_doc[self.a_last], minlength=len(self.n_a))

    def distinct_links(self) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
        """Each document's identities (document, A id, links), and its other pairs (document, pair, links).

        Only tokens of irregular groups are paired up. A pair of theirs that the map knows is an identity all the same.
        """
        odd = np.flatnonzero(~self.exact)
        links = self.links[odd]
        token = np.repeat(odd, links)
        other = np.arange(len(token)) + np.repeat(self.first[odd] - (np.cumsum(links) - links), links)
        a, b, doc = self.a[token], self.b[other], self.a_doc[token]
        known = self.same[a] == b
        identities = np.concatenate([
            (self.a_doc[self.exact] << B_BITS) | self.a[self.exact], (doc[known] << B_BITS) | a[known],
        ])
        key, times = np.unique(identities, return_counts=True)
        known = ~known
        pairs, pair_times = np.unique((doc[known] << (2 * B_BITS)) | (a[known] << B_BITS) | b[known], return_counts=True)
        mask = (1 << B_BITS) - 1, (1 << 2 * B_BITS) - 1
        return (key >> B_BITS, key & mask[0], times), (pairs >> (2 * B_BITS), pairs & mask[1], pair_times)

    def group_texts(self, tokens: np.ndarray, a_size: int, b_size: int) -> list[bytes]:
        """The groups of each document as text: ``a1,a2|b1;a3|b2``. ``tokens`` has the ids with the mark that follows them."""
        b_before = np.concatenate([[0], np.flatnonzero(self.b_last) + 1])
        a_before = np.concatenate([[0], np.flatnonzero(self.a_last) + 1])
        place_a = np.arange(len(self.a)) + b_before[self.a_group]
        place_b = np.arange(len(self.b)) + a_before[self.b_group + 1] if len(self.b) else np.zeros(0, np.int64)
        written = np.empty(len(self.a) + len(self.b), np.int64)
        written[place_a] = self.a + self.a_last * a_size
        written[place_b] = 2 * a_size + self.b + self.b_last * b_size
        marks = tokens[written]
        stops = np.cumsum(self.n_a + self.n_b).tolist()
        return [marks[start:stop].tobytes().translate(None, b"\0")[:-1] for start, stop in zip([0, *stops], stops, strict=False)]


def _aligned(batches: Iterable[pa.RecordBatch], vocabularies: Vocabularies) -> Iterator[tuple[pa.RecordBatch, Aligned]]:
    for batch in slices(batches, "a", SLICE):
        columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in "ab")
        yield batch, Aligned(vocabularies, *columns)


def _count(vocabularies):
    """(``pair``, ``docs``, ``exact``): a vector of identities, and sums for other pairs; the null pair counts the (document, pair)s of these."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabularies.value
        vector, sums, total = np.zeros(len(known.same), np.int64), Tally(SPARSE), 0

        def out(pairs, docs, exact) -> Iterator[pa.RecordBatch]:
            for start in range(0, len(docs), 100_000):
                part = slice(start, start + 100_000)
                flags = np.full(len(docs[part]), exact)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[part], pa.int64()), pa.array(docs[part], pa.int64()), pa.array(flags)], ["pair", "docs", "exact"],
                )

        for _, found in _aligned(batches, known):
            (_, a, _), (_, pairs, _) = found.distinct_links()
            vector += np.bincount(a, minlength=len(vector))
            sums.add(*np.unique(pairs, return_counts=True))
            total += len(pairs)
            if sums.size > 4 * SPARSE:
                yield from out(*sums.total(), False)
                sums = Tally(SPARSE)
        seen = np.flatnonzero(vector)
        yield from out((seen << B_BITS) | known.same[seen], vector[seen], True)
        yield from out(*sums.total(), False)
        yield from out([None], [total], False)

    return run


@dataclass
class Counts:
    """What scoring tasks know: the documents of exact pairs by A id, each A id's highest count, and the irregular pairs that are not rare."""

    exact: np.ndarray
    highest: np.ndarray
    pairs: np.ndarray
    docs: np.ndarray


def _score(vocabularies, counts, a_size: int, b_size: int):
    """A row for each document; links of rare pairs are listed for the shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, of = vocabularies.value, counts.value
        tokens = np.array([
            b"%d%c" % (i, mark) for size, marks in ((a_size, b",|"), (b_size, b",;")) for mark in marks for i in range(size)
        ], "S6")
        for batch, found in _aligned(batches, known):
            n = batch.num_rows
            best, sums = np.zeros(n, np.int64), np.zeros(n, np.int64)
            (doc, a, links), (pair_doc, pair, pair_links) = found.distinct_links()

            def add(doc: np.ndarray, a: np.ndarray, links: np.ndarray, docs: np.ndarray) -> None:
                top = docs == of.highest[a]
                best[:] += np.bincount(doc[top], weights=links[top], minlength=n).astype(np.int64)
                np.add.at(sums, doc, links * docs)  # whole numbers, as sums may pass 2**53

            add(doc, a, links, of.exact[a])
            rare = np.ones(len(pair), bool)
            if len(of.pairs):
                at = np.minimum(np.searchsorted(of.pairs, pair), len(of.pairs) - 1)
                frequent = of.pairs[at] == pair
                add(pair_doc[frequent], pair[frequent] >> B_BITS, pair_links[frequent], of.docs[at[frequent]])
                rare = ~frequent
            borders = np.concatenate([[0], np.cumsum(np.bincount(pair_doc[rare], minlength=n))]).astype(np.int32)
            listed = pa.StructArray.from_arrays([pa.array(pair[rare]), pa.array(pair_links[rare])], ["pair", "links"])
            hashes = [hashlib.sha256(t).hexdigest() if t else "" for t in found.group_texts(tokens, a_size, b_size)]
            columns = [
                batch.column(batch.schema.get_field_index("row")), batch.column(batch.schema.get_field_index("doc_id")),
                found.n_a, found.n_b, found.n_groups(), found.n_links(), best, sums,
                pa.array(hashes, pa.string()), pa.ListArray.from_arrays(pa.array(borders), listed),
            ]
            names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "rare"]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], names)

    return run


@dataclass
class Alignment:
    """The alignment of a corpus: scored documents, and the documents of each id pair (``a``, ``b``, ``docs``, ``exact``)."""

    documents: DataFrame
    pairs: DataFrame


def align(docs: DataFrame, a_file: bytes, b_file: bytes, pattern: str, share: float = SHARE) -> Alignment:
    """Align a byte-level BPE vocabulary (A, a JSON file; ``pattern`` splits its texts) with a piece model (B) over all texts."""
    if not SHARE <= share <= 1:
        raise ValueError(f"share is from {SHARE} to 1")
    spark = docs.sparkSession
    context, store = spark.sparkContext, Store(spark, "alignment")
    vocabularies = Vocabularies.of(a_file, b_file)
    a_size, b_size = len(vocabularies.a_lengths), len(vocabularies.b_lengths)
    shared = context.broadcast(vocabularies)
    texts = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    encoded = texts.mapInArrow(_encode(context.broadcast((a_file, b_file)), pattern), ENCODED)
    encoded = store.put("ids", encoded.withColumn("row", F.monotonically_increasing_id()))

    counted = encoded.mapInArrow(_count(shared), "pair long, docs long, exact boolean")
    counted = store.put("pairs", counted.groupBy("pair", "exact").agg(F.sum("docs").alias("docs")))
    total = counted.filter(F.col("pair").isNull()).agg(F.sum("docs")).first()[0] or 0
    pairs = counted.filter(F.col("pair").isNotNull()).withColumn("a", F.shiftright("pair", B_BITS))
    frequent_from = max(1, int(np.ceil(total * share)))

    def columns(df: DataFrame, *names: str) -> list[np.ndarray]:
        table = df.select(*names).toArrow()
        return [table[n].to_numpy() for n in names]

    # A vector for each vocabulary id, and a million pairs at most.
    a, exact_docs = columns(pairs.filter("exact"), "a", "docs")
    exact, highest = np.zeros(a_size, np.int64), np.zeros(a_size, np.int64)
    exact[a] = exact_docs
    a, most = columns(pairs.groupBy("a").agg(F.max("docs").alias("most")), "a", "most")
    highest[a] = most
    pair, pair_docs = columns(pairs.filter(~F.col("exact") & (F.col("docs") >= frequent_from)), "pair", "docs")
    order = np.argsort(pair)
    known = context.broadcast(Counts(exact, highest, pair[order], pair_docs[order]))

    scored = store.put("scored", encoded.mapInArrow(_score(shared, known, a_size, b_size), SCORED))
    store.free("ids")
    # A row for each A id.
    seen = np.flatnonzero(highest)
    top = spark.createDataFrame(pa.table({"a": pa.array(seen), "most": pa.array(highest[seen])}), "a long, most long")
    rare = (
        pairs.filter(~F.col("exact") & (F.col("docs") < frequent_from)).join(F.broadcast(top), "a")
        .select("pair", "docs", (F.col("docs") == F.col("most")).cast("long").alias("best"))
    )
    links = scored.select("row", F.explode("rare").alias("link")).select("row", "link.pair", "link.links")
    more = links.join(rare, "pair").groupBy("row").agg(
        F.sum(F.col("links") * F.col("best")).alias("more_best"), F.sum(F.col("links") * F.col("docs")).alias("more_sum"))
    documents = scored.join(more, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256",
    )
    mask = (1 << B_BITS) - 1
    table = pairs.select("a", F.col("pair").bitwiseAND(F.lit(mask)).alias("b"), "docs", "exact")
    return Alignment(documents, table)
