"""Phrase collocations: ids ranked by frequency, pairs of ids counted in tiles, frequent pairs ranked again, level by level.

A-Z are lower-cased, texts cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and these into words ``[^\\x20\\x09]+``; everything is counted for each language (null:
``und``). A phrase of k words is the pair of its first and its last k-1 words, which share k-2, so each level counts neighbouring ids alone:

1. Words are counted. The most frequent ones, a million at most whatever the corpus, get ids ranked by frequency inside their
   language, and the texts are stored as ids; words that are not frequent are gaps.
2. The pairs of neighbouring ids are counted in tiles of ``SIDE`` x ``SIDE``: a tile that a slice fills well is a dense array of bins, the
   others are sorted (cell, count) lists. Tasks pass on sums of cells, and Spark adds them up.
3. The most frequent pairs get ranked ids in turn, the stream of ids becomes one of pair ids, and so on up to ``max_words`` words.

Where a level has more frequent phrases than ids, the rarer ones have none. They are told by a bitmap of their hashes (a false
hit costs a count and changes nothing) and counted by their text. So the number of ids changes the plan alone: every phrase is
counted exactly, at every size.

A candidate occurs ``min_count`` times or more. Cut after its first words it has floor(1000 a n / (l r)) with a its count, l and r those of the parts and n
the language's words; the lowest cut counts, the shortest first part of ties. A candidate inside a longer one with the same count is dropped; as the phrases in between
have that count too, the next longer ones decide. Arithmetic is in 38 digits.

Null and empty texts have no words. Long texts are handled whole, in slices. Repeated rows and ids count each; ``doc_id`` is not read. An empty table
gives an empty result. Extra columns are left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from outlay.llm.hashing import mixed, word_hashes
from outlay.llm.tables import Store, Tally, pick, slices

HOT_SHARE = 1e-5
ID_BITS = 20  # ids of phrases of one length
LIMIT = 1 << ID_BITS
SIDE_BITS = 10
SIDE = 1 << SIDE_BITS
DENSE = SIDE * SIDE // 32  # occurrences in a slice from which a tile is worth an array
DENSE_TILES = 4  # arrays of 8 MB in a task; further tiles are lists
SPARSE = 1_000_000
DISTINCT = 250_000
SLICE = 2 << 20
BITMAP = 1 << 27
BUCKET = 4096 * 8  # bits in a row of bitmap_construct_agg
GAP = b"\xff"  # no byte of UTF-8

_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_CUTS = b".,;:!?\n\x0b\x0c\r"
WORDS_ONLY = bytes.maketrans(_UPPER + _CUTS + b"\t", _LOWER + b" " * 11)
WITH_GAPS = bytes.maketrans(_UPPER + _CUTS + b"\t", _LOWER + GAP * 10 + b" ")

COUNTS = "cell long, lang string, phrase string, count long"


def _by_language(batch: pa.RecordBatch) -> dict[str, list[bytes]]:
    found: dict[str, list[bytes]] = {}
    texts = batch.column(1).cast(pa.binary()).to_pylist()
    for lang, text in zip(batch.column(0).to_pylist(), texts, strict=True):
        if text:
            found.setdefault(lang, []).append(text)
    return found


def _counted(cells, langs, phrases, counts) -> pa.RecordBatch:
    n = len(counts)
    return pa.RecordBatch.from_arrays(
        [
            pa.nulls(n, pa.int64()) if cells is None else pa.array(cells, pa.int64()),
            pa.nulls(n, pa.string()) if langs is None else pa.array(langs, pa.string()),
            pa.nulls(n, pa.string()) if phrases is None else pa.array(phrases, pa.binary()).cast(pa.string()),
            pa.array(counts, pa.int64()),
        ],
        ["cell", "lang", "phrase", "count"],
    )


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(``lang``, word, count); the null phrase counts all words."""
    held: dict[str, Counter] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            if counts:
                yield _counted(None, [lang] * len(counts), list(counts), list(counts.values()))
                yield _counted(None, [lang], [None], [sum(counts.values())])
        held.clear()

    for batch in slices(batches, limit=SLICE):
        for lang, texts in _by_language(batch).items():
            counts = held.setdefault(lang, Counter())
            for text in texts:
                counts.update(text.translate(WORDS_ONLY).split())
        if sum(map(len, held.values())) > DISTINCT:
            yield from out()
    yield from out()


def _phrase_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash for each run of ``length`` hashes of words."""
    total = words[: max(0, len(words) - length + 1)]
    for k in range(1, length):
        total = mixed(total, words[k : len(total) + k])
    return total


def _in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(BITMAP - 1)
    return (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _encode(word_ids, bitmap):
    """A row for each slice and language: the ids of its words, -1 for gaps, from ``LIMIT`` on places in the list of other frequent words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, bits = word_ids.value, bitmap.value if bitmap else None
        for batch in slices(batches, limit=SLICE):
            for lang, texts in _by_language(batch).items():
                known = ids_of.get(lang, {})
                # A gap after each text, and blanks around gaps.
                tokens = (b" \xff ".join(t.translate(WITH_GAPS).replace(GAP, b" \xff ") for t in texts)).split()
                ids = np.fromiter(map(known.get, tokens, repeat(-1)), np.int32, len(tokens))
                others: dict[bytes, int] = {}
                if bits is not None:
                    unknown = np.flatnonzero(ids < 0)
                    frequent = _in_bitmap(bits, word_hashes([tokens[i] for i in unknown.tolist()]))
                    for place in unknown[frequent].tolist():
                        if tokens[place] != GAP:
                            ids[place] = LIMIT + others.setdefault(tokens[place], len(others))
                if (ids >= 0).any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang]), pa.array([ids.tobytes()], pa.binary()), pa.array([list(others)], pa.list_(pa.binary()))],
                        ["lang", "ids", "others"],
                    )

    return run


class Tiles:
    """Counts of pairs of ids: dense arrays for well-filled tiles, sorted lists of cells for the others."""

    def __init__(self, dense_from: int = DENSE, dense_tiles: int = DENSE_TILES, sparse: int = SPARSE):
        self.dense: dict[int, np.ndarray] = {}
        self.dense_from, self.dense_tiles, self.limit = dense_from, dense_tiles, sparse
        self.sparse = Tally(sparse // 4)

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        tile = ((left >> SIDE_BITS) << (ID_BITS - SIDE_BITS)) | (right >> SIDE_BITS)
        filled = np.bincount(tile) if len(tile) else np.zeros(0, np.int64)
        for t in np.flatnonzero(filled >= self.dense_from).tolist():
            if t not in self.dense:
                if len(self.dense) >= self.dense_tiles:
                    continue
                self.dense[t] = np.zeros(SIDE * SIDE, np.int64)
            here = tile == t
            bins = ((left[here] & (SIDE - 1)) << SIDE_BITS) | (right[here] & (SIDE - 1))
            self.dense[t] += np.bincount(bins, minlength=SIDE * SIDE)
            left, right, tile = left[~here], right[~here], tile[~here]
        if len(left):
            self.sparse.add(*np.unique((left << ID_BITS) | right, return_counts=True))

    def full(self) -> bool:
        return self.sparse.size > self.limit

    def out(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All (cell, count) so far, a tile or list at a time; counting starts anew."""
        for t, bins in self.dense.items():
            place = np.flatnonzero(bins)
            rows, columns = t >> (ID_BITS - SIDE_BITS), t & (LIMIT // SIDE - 1)
            left = (rows << SIDE_BITS) | (place >> SIDE_BITS)
            yield (left << ID_BITS) | (columns << SIDE_BITS) | (place & (SIDE - 1)), bins[place]
        cells, counts = self.sparse.total()
        if len(cells):
            yield cells.astype(np.int64), counts
        self.dense, self.sparse = {}, Tally(self.limit // 4)


@dataclass
class Level:
    """What tasks know of the frequent phrases of one length: ids of heavy cells, and a bitmap of the others."""

    cells: np.ndarray
    ids: np.ndarray
    bitmap: np.ndarray | None


@dataclass
class Known:
    """The levels from two words on; the words with ids and their hashes, which only phrases without ids need."""

    words: list[bytes] = field(default_factory=list)
    hashes: np.ndarray | None = None
    levels: list[Level] = field(default_factory=list)


class _Slice:
    """One stored row: the ids of its words and the phrase ids of the level that has been reached."""

    def __init__(self, known: Known, ids: np.ndarray, others: list[bytes]):
        self.known, self.ids, self.others = known, ids, others
        self.now, self.length = ids, 1
        self.hashes = None
        if known.hashes is not None:
            table = np.concatenate([known.hashes, word_hashes(others), np.zeros(1, np.uint64)])
            self.hashes = table[np.where(ids < 0, len(table) - 1, np.where(ids < LIMIT, ids, ids - LIMIT + len(known.hashes)))]

    def phrase(self, place: int, length: int) -> bytes:
        return b" ".join(
            self.known.words[i] if i < LIMIT else self.others[i - LIMIT] for i in self.ids[place : place + length].tolist()
        )

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The places where both the phrase and the next one are frequent, and the two ids."""
        left, right = self.now[:-1], self.now[1:]
        places = np.flatnonzero((left >= 0) & (right >= 0))
        return places, left[places], right[places]

    def climb(self, level: Level) -> None:
        """Replace the ids by those of the phrases that are one word longer."""
        places, left, right = self.pairs()
        self.length += 1
        longer = np.full(max(0, len(self.now) - 1), -1, np.int64)
        cell = np.where((left < LIMIT) & (right < LIMIT), (left << ID_BITS) | right, -1)
        if len(level.cells):
            at = np.minimum(np.searchsorted(level.cells, cell), len(level.cells) - 1)
            found = level.cells[at] == cell
            longer[places[found]] = level.ids[at[found]]
        else:
            found = np.zeros(len(places), bool)
        if level.bitmap is not None and not found.all():
            rest = np.flatnonzero(~found)
            rest = rest[_in_bitmap(level.bitmap, _phrase_hashes(self.hashes, self.length)[places[rest]])]
            _, back = np.unique((left[rest] << 32) | right[rest], return_inverse=True)
            longer[places[rest]] = LIMIT + back
        self.now = longer


def _count_pairs(known):
    """Count the phrases that are one word longer than the last known level: cells of heavy pairs, texts of the others."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = known.value
        tiles, texts = Tiles(), Counter()

        def sums() -> Iterator[pa.RecordBatch]:
            for cells, counts in tiles.out():
                for start in range(0, len(cells), 200_000):
                    part = slice(start, start + 200_000)
                    yield _counted(cells[part], None, None, counts[part])

        def others() -> Iterator[pa.RecordBatch]:
            if texts:
                langs, phrases = zip(*texts, strict=True)
                yield _counted(None, langs, phrases, list(texts.values()))
                texts.clear()

        for batch in batches:
            for lang, ids, rest in zip(*(batch.column(i) for i in range(3)), strict=True):
                here = _Slice(levels, np.frombuffer(ids.as_buffer(), np.int32).astype(np.int64), rest.as_py())
                for level in levels.levels:
                    here.climb(level)
                places, left, right = here.pairs()
                heavy = (left < LIMIT) & (right < LIMIT)
                tiles.add(left[heavy], right[heavy])
                if not heavy.all():
                    keys = (left[~heavy] << 32) | right[~heavy]
                    _, first, counts = np.unique(keys, return_index=True, return_counts=True)
                    for place, count in zip(places[~heavy][first].tolist(), counts.tolist(), strict=True):
                        texts[lang.as_py(), here.phrase(place, here.length + 1)] += count
                if tiles.full():
                    yield from sums()
                if len(texts) > 200_000:
                    yield from others()
        yield from sums()
        yield from others()

    return run


def _hash_places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        phrases = [p.split(b" ") for p in batch.column(0).cast(pa.binary()).to_pylist()]
        hashes = [int(_phrase_hashes(word_hashes(words), len(words))[0]) & (BITMAP - 1) for words in phrases]
        yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64())], ["place"])


def _bitmap(phrases: DataFrame) -> np.ndarray:
    """The hashes of ``phrase`` as ``BITMAP`` bits: a size fixed beforehand, built in tasks."""
    places = phrases.select("phrase").mapInArrow(_hash_places, "place long").select((F.col("place") + 1).alias("place"))
    rows = (
        places.groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).collect()
    )
    found = np.zeros(BITMAP // 8, np.uint8)
    for bucket, bits in rows:
        start = (bucket - 1) * BUCKET // 8
        found[start : start + len(bits)] = np.frombuffer(bytes(bits), np.uint8)
    return found


def _ids_from(frequent: DataFrame, at_least: int, most: int) -> tuple[int, bool]:
    """The least count from which on phrases get an id, so that ``most`` do at the utmost, and whether some get none.

    Counts fall into classes of an eighth of an octave; a class gets ids as a whole.
    """
    size = F.floor(F.log2(F.col("f")) * 8)
    classes = frequent.groupBy(size.alias("size")).agg(
        F.min("f").alias("least"), F.max("f").alias("largest"), F.count(F.lit(1)).alias("n")).collect()
    bound, total = at_least, 0
    for row in sorted(classes, key=lambda r: -r.largest):
        total += row.n
        if total > most:
            bound = max(at_least, row.largest + 1)
            break
    return bound, any(row.least < bound for row in classes)


def _ranked(frequent: DataFrame, least: int) -> pa.Table:
    """The phrases with ids, in the order of these: by language, then frequency."""
    found = frequent.filter(F.col("f") >= least).select("lang", "phrase", "f", "cell").toArrow()
    found = found.sort_by([("lang", "ascending"), ("f", "descending"), ("phrase", "ascending")])
    return found.append_column("id", pa.array(np.arange(found.num_rows), pa.int64()))


@dataclass
class Mined:
    """The frequent phrases (``lang``, ``phrase``, ``f``, ``words``), and the words of each language (``lang``, ``n``)."""

    frequent: DataFrame
    totals: DataFrame
    all_words: int


def mine(docs: DataFrame, min_count: int = 100, max_words: int = 5, most_ids: int = LIMIT) -> Mined:
    """Count the phrases of up to ``max_words`` words that occur ``min_count`` times or more in their language."""
    if min_count < 1 or max_words < 1 or not 0 <= most_ids <= LIMIT:
        raise ValueError(f"min_count and max_words are 1 or more, most_ids is from 0 to {LIMIT}")
    spark = docs.sparkSession
    context, store = spark.sparkContext, Store(spark, "collocations")
    texts = pick(docs, "lang", "text").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")

    counted = texts.mapInArrow(_count_words, COUNTS).groupBy("lang", "phrase").agg(F.sum("count").alias("f"))
    kept = store.put("words", counted.filter(F.col("phrase").isNull() | (F.col("f") >= min_count)).select(
        "lang", "phrase", "f", F.lit(None).cast("long").alias("cell")))
    totals = kept.filter(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))
    all_words = totals.agg(F.sum("n")).first()[0] or 0

    frequent = kept.filter(F.col("phrase").isNotNull())
    levels, known = [frequent], Known()
    least, some_without = _ids_from(frequent, min_count, most_ids)
    ranked = _ranked(frequent, least)
    words = ranked["phrase"].cast(pa.binary()).to_pylist()
    ids_of: dict[str, dict[bytes, int]] = {}
    for lang, word, place in zip(ranked["lang"].to_pylist(), words, ranked["id"].to_pylist(), strict=True):
        ids_of.setdefault(lang, {})[word] = place
    bits = _bitmap(frequent.filter(F.col("f") < least)) if some_without else None
    encoded = store.put("ids", texts.mapInArrow(
        _encode(context.broadcast(ids_of), None if bits is None else context.broadcast(bits)),
        "lang string, ids binary, others array<binary>"))
    # Words and hashes that only phrases without ids need; from the first level that has some.
    if some_without:
        known.words, known.hashes = words, word_hashes(words)

    for length in range(2, max_words + 1):
        if length > 2:
            cells = ranked["cell"].to_numpy()
            order = np.argsort(cells)
            bits = _bitmap(frequent.filter(F.col("f") < least)) if some_without else None
            known.levels.append(Level(cells[order], ranked["id"].to_numpy()[order], bits))
            if some_without and known.hashes is None:
                known.words, known.hashes = words, word_hashes(words)
        counts = (
            encoded.mapInArrow(_count_pairs(context.broadcast(known)), COUNTS)
            .groupBy("cell", "lang", "phrase").agg(F.sum("count").alias("f")).filter(F.col("f") >= min_count)
        )
        counts = store.put(f"counts-{length}", counts)
        # Names of ids: a million rows at most.
        names = spark.createDataFrame(ranked.select(["id", "lang", "phrase"]), "id long, lang string, phrase string")
        left = F.broadcast(names.toDF("left", "left_lang", "left_phrase"))
        right = F.broadcast(names.toDF("right", "right_lang", "right_phrase"))
        whole = F.concat_ws(" ", "left_phrase", F.substring_index("right_phrase", " ", -1))
        named = (
            counts.filter(F.col("cell").isNotNull())
            .withColumns({"left": F.shiftright("cell", ID_BITS), "right": F.col("cell").bitwiseAND(F.lit(LIMIT - 1))})
            .join(left, "left").join(right, "right")
            .select(F.col("left_lang").alias("lang"), whole.alias("phrase"), "f", "cell")
        )
        by_text = counts.filter(F.col("cell").isNull()).select("lang", "phrase", "f", "cell")
        frequent = store.put(f"frequent-{length}", named.unionByName(by_text))
        store.free(f"counts-{length}")
        levels.append(frequent)
        # Parts of a phrase are at least as frequent as it, so with bounds that never fall they have ids where it has one.
        least, some_without = _ids_from(frequent, least, most_ids)
        ranked = _ranked(frequent, least)
        if not ranked.num_rows and not some_without:
            break
    store.free("ids")
    found = levels[0].select("lang", "phrase", "f", F.lit(1).alias("words"))
    for i, level in enumerate(levels[1:], 2):
        found = found.unionByName(level.select("lang", "phrase", "f", F.lit(i).alias("words")))
    return Mined(found, totals, all_words)


def _with_count(cuts: DataFrame, mined: Mined, min_count: int, part: str, count: str) -> DataFrame:
    """Add the count of ``part``. Only parts with a large share can have many candidates; they are few and broadcast."""
    hot = max(min_count, mined.all_words * HOT_SHARE)
    parts = mined.frequent.select(F.col("lang"), F.col("phrase").alias(part), F.col("f").alias(count))
    # At most 1 / HOT_SHARE phrases of each length.
    few = F.broadcast(parts.filter(F.col(count) >= hot))
    keys = ["lang", part]
    return cuts.join(few, keys).unionByName(
        cuts.join(few, keys, "left_anti").join(parts.filter(F.col(count) < hot), keys)
    )


def rank_collocations(mined: Mined, min_count: int = 100, top: int = 2000) -> DataFrame:
    """The ``top`` candidates of each language by score: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    candidates = mined.frequent.filter(F.col("words") > 1).select("lang", "phrase", F.col("f").alias("a"), "words")
    split = F.split("phrase", " ")

    def run_of(start, length):
        return F.array_join(F.slice(split, start, length), " ")

    shorter = candidates.filter(F.col("words") > 2)
    inside = shorter.select("lang", "a", F.explode(F.array(
        run_of(F.lit(1), F.col("words") - 1), run_of(F.lit(2), F.col("words") - 1))).alias("phrase"))
    kept = candidates.join(inside, ["lang", "phrase", "a"], "left_anti")
    cuts = (
        kept.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
        .select("lang", "phrase", "a", "at", run_of(F.lit(1), F.col("at")).alias("first"),
                run_of(F.col("at") + 1, F.col("words") - F.col("at")).alias("rest"))
    )
    cuts = _with_count(_with_count(cuts, mined, min_count, "first", "l"), mined, min_count, "rest", "r")
    exact = {c: F.col(c).cast("decimal(38,0)") for c in "alrn"}
    score = F.expr("(1000 * a38 * n38) div (l38 * r38)")
    scored = (
        cuts.join(mined.totals, "lang").withColumns({f"{c}38": v for c, v in exact.items()})
        .withColumn("score", score).groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "at", "l", "r", "a", "n")).alias("best"))
        .select("lang", "phrase", *[F.col(f"best.{c}").alias(c) for c in ("a", "l", "r", "n", "score")])
    )
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        scored.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


def collocations(
    docs: DataFrame, min_count: int = 100, max_words: int = 5, top: int = 2000, most_ids: int = LIMIT,
) -> DataFrame:
    return rank_collocations(mine(docs, min_count, max_words, most_ids), min_count, top)
