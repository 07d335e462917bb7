"""Benchmark decontamination by spaced-seed hashing.

A mask fixes which words of a window are hashed and which are ignored, so a window still
matches if the words that differ fall on ignored places. The hashes of all benchmark windows under
all masks are joined to those of all document windows; each hit fixes an alignment of an item with a
document, on which the words are compared one by one. On an alignment the longest stretch is taken of whose words
a share of ``similarity`` or more are equal. It is an overlap if it has at least ``min_words`` words (the
whole item, if that is shorter).

Words are in lower case, cut at ASCII white space and ASCII punctuation; in scripts that put no blanks between words
(Chinese, Japanese, Thai, Lao, Khmer, Burmese, Tibetan, ...) each character is a word. Items of under 13 words have masks of their own,
which find every substitution that a similarity of 0.8 allows; items of under ``SHORT`` words are never reported. Null and empty texts have no overlap, on either side; repeated documents and
repeated items are each reported. Of several overlaps of one row with one item the one with the most equal words counts,
the first of them if there are several.

Documents are read in one pass against the benchmark in memory, ``BLOCK_BYTES`` of its text at a time; a
larger benchmark takes as many passes as it has blocks. Documents are never shuffled.
"""

from __future__ import annotations

import math
import re
import string
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outlay.llm.tables import pick, slices

# Places of a window that are hashed. Of 13 words any two may differ, of 15 any three and of 20 any four: some window under
# some mask still has all its hashed words equal, and so it has in every longer stretch of which 0.8 is equal.
MASKS = ("111010011", "1100101011", "11110000101", "100011001101", "11111011")
# The same for items of under 13 words, by the most words of an item: any one of 5 to 9 may differ, any two of 10 to 12.
SHORT_MASKS = {
    6: ("1111", "10111", "11011", "11101"), 9: ("11111", "111101", "110111"), 12: ("11111", "111011", "11010011"),
}
SHORT = 5
MIN_WORDS = 13
SIMILARITY = 0.8
BLOCK_BYTES = 16 << 20
STEP = np.uint64(0x9E3779B97F4A7C15)
# Characters of the scripts without blanks between words.
UNSPACED = re.compile(
    "([\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u1950-\u19ff\u1a20-\u1aaf\u3005-\u3007\u3040-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf"
    "\u4e00-\ua4cf\ua980-\ua9ff\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff])"
)
_BLANKS = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


def words_of(text: str | None) -> list[bytes]:
    text = (text or "").lower()
    if not text.isascii():
        text = UNSPACED.sub(r" \1 ", text)
    return text.encode("utf-8", "surrogatepass").translate(_BLANKS).split()


def masks_of(words: int) -> tuple[str, ...]:
    """The masks of an item of so many words."""
    return next((masks for most, masks in SHORT_MASKS.items() if words <= most), MASKS)


def _window_hashes(ids: np.ndarray, mask: str) -> np.ndarray:
    """The hash of every window of ``ids`` under the mask; 0 where a hashed word is unknown (id 0)."""
    n = len(ids) - len(mask) + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    total, known = np.full(n, int(mask, 2), np.uint64), np.ones(n, bool)
    for k in (k for k, c in enumerate(mask) if c == "1"):
        part = ids[k : k + n]
        total = (total ^ part) * STEP
        total ^= total >> np.uint64(29)
        known &= part > 0
    return np.where(known, total | np.uint64(1), np.uint64(0))


def longest_stretch(equal: np.ndarray, similarity: float) -> tuple[int, int]:
    """Start and end of the longest stretch with a share of ``similarity`` equal; the first of them, empty if there is none."""
    sums = np.concatenate([[0.0], np.cumsum(equal - similarity)])
    lowest = np.minimum.accumulate(sums)  # falls, so the first start that is low enough is found by bisection
    starts = np.searchsorted(-lowest, -(sums + 1e-9), side="left")
    end = int((np.arange(len(sums)) - starts).argmax())
    return int(starts[end]), end


class Benchmark:
    """A block of items: their words as ids, and a sorted table of their window hashes."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.vocabulary: dict[bytes, int] = {}
        self.ids, self.words = [], []
        hashes, item_of, place_of = [], [], []
        masks = set(MASKS)
        for item, text in items:
            words = words_of(text)
            if len(words) < SHORT:
                continue
            for word in words:
                self.vocabulary.setdefault(word, len(self.vocabulary) + 1)
            ids = np.array([self.vocabulary[w] for w in words], np.uint64)
            own = masks_of(len(words))
            masks.update(own)
            for mask in own:
                found = _window_hashes(ids, mask)
                hashes.append(found)
                item_of.append(np.full(len(found), len(self.ids)))
                place_of.append(np.arange(len(found)))
            self.ids.append(item)
            self.words.append(ids)
        self.masks = sorted(masks, key=lambda m: (len(m), m))
        joined = np.concatenate([np.zeros(0, np.uint64), *hashes])
        order = np.argsort(joined, kind="stable")
        self.hashes = joined[order]
        self.items = np.concatenate([np.zeros(0, np.int64), *item_of])[order]
        self.places = np.concatenate([np.zeros(0, np.int64), *place_of])[order]
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def overlaps(
        self, texts: list[str | None], min_words: int, similarity: float
    ) -> list[tuple[int, int, int, int, int]]:
        """(text, item, first word in the text, words, equal words) of every overlap, for a list of texts."""
        gap = max(map(len, self.masks))
        parts, starts, at = [np.zeros(gap, np.uint64)], [], gap
        lengths = []
        for text in texts:
            words = words_of(text)
            parts += [np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.uint64, len(words)), np.zeros(gap, np.uint64)]
            starts.append(at)
            lengths.append(len(words))
            at += len(words) + gap
        ids = np.concatenate(parts)
        tried, best = set(), {}
        starts_at = np.array(starts)
        for mask in self.masks:
            found = _window_hashes(ids, mask)
            places = np.flatnonzero(self.filter[(found >> np.uint64(44)).astype(np.int64)] & (found > 0))
            low = np.searchsorted(self.hashes, found[places], side="left")
            high = np.searchsorted(self.hashes, found[places], side="right")
            hit = high > low
            doc = np.searchsorted(starts_at, places[hit], side="right") - 1
            for place, row, a, b in zip(places[hit].tolist(), doc.tolist(), low[hit].tolist(), high[hit].tolist(), strict=True):
                for k in range(a, b):
                    item = int(self.items[k])
                    shift = place - starts[row] - int(self.places[k])
                    if (row, item, shift) in tried:
                        continue
                    tried.add((row, item, shift))
                    words = self.words[item]
                    first, last = max(0, -shift), min(len(words), lengths[row] - shift)
                    base = starts[row] + shift
                    equal = ids[base + first : base + last] == words[first:last]
                    start, end = longest_stretch(equal, similarity)
                    same = int(equal[start:end].sum())
                    if end - start >= min(min_words, len(words)):
                        claim = (-same, shift + first + start, end - start)
                        if claim < best.get((row, item), (1,)):
                            best[(row, item)] = claim
        return [(row, item, start, n, -same) for (row, item), (same, start, n) in sorted(best.items())]


def _blocks(benchmark: DataFrame, block_bytes: int):
    """The benchmark's items in blocks of about ``block_bytes`` of text, one at a time."""
    items = pick(benchmark, "item_id", "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    for block in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield Benchmark(sorted(((r[0], r[1]) for r in part.collect()), key=lambda r: (r[0] is None, r[0], r[1] or "")))


def find_overlaps(
    docs: DataFrame, benchmark: DataFrame, *, keep: tuple[str, ...] = ("doc_id",), min_words: int = MIN_WORDS,
    similarity: float = SIMILARITY, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row for each document row and item that overlap: ``keep``, ``item_id``, the first word's place in the
    document, the number of words of the stretch and how many of them are equal."""
    source = pick(docs, *keep, "text").withColumnRenamed("text", "_text")
    kind = pick(benchmark, "item_id").schema[0]
    schema = T.StructType([
        *source.schema.fields[:-1], T.StructField("item_id", kind.dataType),
        *[T.StructField(name, T.LongType(), False) for name in ("first_word", "n_words", "n_equal")],
    ])
    names = [f.name for f in schema.fields]
    out = None
    for block in _blocks(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            items = shared.value
            for part in slices(batches, "_text"):
                found = items.overlaps(part.column(len(keep)).to_pylist(), min_words, similarity)
                rows = part.take(pa.array([f[0] for f in found], pa.int64()))
                columns = [pa.array([items.ids[f[1]] for f in found]).cast(pa.int64())]
                columns += [pa.array([f[i] for f in found], pa.int64()) for i in (2, 3, 4)]
                yield pa.RecordBatch.from_arrays([*rows.columns[: len(keep)], *columns], names)

        part = source.mapInArrow(run, schema)
        out = part if out is None else out.unionAll(part)
    return out


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, min_words: int = MIN_WORDS, similarity: float = SIMILARITY,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows without any overlap, with all their columns."""
    at = docs.columns.index("text")
    for block in _blocks(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            for batch in batches:
                for part in slices([batch], batch.schema.names[at]):
                    clean = np.ones(part.num_rows, bool)
                    found = shared.value.overlaps(part.column(at).to_pylist(), min_words, similarity)
                    clean[[f[0] for f in found]] = False
                    yield part.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
