"""Substring dedup over words by prefix-partitioned suffix trees, cut where they are ``WINDOW`` words deep.

A window is ``WINDOW`` words in a row; of the windows with the same words the earliest (by id, then row, then place) stays. In the tree of all suffixes these
windows are the internal nodes at that depth; nodes further down repeat no other words, so the trees end there, and a suffix is its first ``WINDOW`` words.

* Texts with the same words are one text, represented by the first; all words of the others repeat.
* Every window has one anchor, the run of ``ANCHOR`` words with the
  smallest hash inside it; equal windows have equal anchors, and about one run in seven is an anchor. A suffix whose
  anchor occurs once in the corpus is a leaf below no deep node, and is never shuffled.
* Each task merges its own equal suffixes first: of equal ones it passes on only the earliest,
  and marks the rest. So a passage that a third of all texts share reaches the shuffle once for each ``CHUNK`` of suffixes.
* What is left is dealt out by prefixes of variable length: the suffixes of each prefix of ``PREFIX_WORDS`` words are counted, and those of prefixes that hold more than
  ``GROUP_BYTES`` are counted again by a prefix that many words longer, up to the whole window. Each last prefix is one subtree, in one task.
* The trees are built in rounds, each over the prefixes whose hash falls into it: the runs of suffixes are read again, and a round shuffles about as many words as the texts
  have. There are ``WINDOW`` rounds at most, since a word is in no more suffixes, whatever the size of the input.
* A subtree is held as its suffixes in the order of their bytes, in which the leaves below a node are neighbours. Spark sorts, and spills where it must; one scan takes off
  the deep internal nodes, runs of equal suffixes, whose first leaf is the earliest copy. What the others cover are the maximal repeats.

Suffixes are compared word by word, in tasks by their hashes first; words of over ``LONG_WORD`` bytes are compared by 160-bit digests, so that no suffix is long. (Equal texts
are found by 128-bit digests.) Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Null texts have no words, texts of
under ``WINDOW`` words have no window and lose nothing. Null ids come last in the order; rows with equal ids are
ordered by their row number, which is the same in each read (``tables.numbered``). Extra columns are left out.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.llm.hashing import run_hashes, word_hashes
from outlay.llm.tables import Store, numbered, pick, slices

WINDOW = 20
ANCHOR = 8
PREFIX_WORDS = 4
GROUP_BYTES = 8 << 20
LONG_WORD = 64
CHUNK = 2_000_000
CHUNK_WORDS = 1 << 20
RUN = 256
SPANS = "array<struct<start: int, end: int>>"
ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def split(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def anchor_places(anchors: np.ndarray, window: int, anchor: int) -> np.ndarray:
    """For each window, where its anchor starts: the first smallest of the runs inside it."""
    steps = window - anchor + 1
    count = max(0, len(anchors) - steps + 1)
    least, place = anchors[:count].copy(), np.arange(count)
    for k in range(1, steps):
        run = anchors[k : count + k]
        lower = run < least
        least[lower] = run[lower]
        place[lower] = np.flatnonzero(lower) + k
    return place


class Vocabulary(dict):
    """Numbers for the words of a chunk, and what stands for them in a suffix."""

    def __init__(self):
        super().__init__()
        self.shown = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.shown)
        # No word holds a tab, so the digest of a long one is never a word.
        self.shown.append(word if len(word) <= LONG_WORD else b"\t" + hashlib.blake2b(word, digest_size=20).hexdigest().encode())
        return number

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def joined_words(words: pa.Array, firsts: np.ndarray, lengths: np.ndarray, ids: np.ndarray | None = None) -> pa.Array:
    """The stretches of ``words`` (of ``words`` at ``ids``, if given) that begin at ``firsts``, with blanks between their words."""
    ends = np.cumsum(lengths)
    at = np.arange(ends[-1]) + np.repeat(firsts - ends + lengths, lengths)
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, words.take(pa.array(at if ids is None else ids[at]))), " ")


def runs_of(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of consecutive ``places`` (sorted) begin, and how many they have, ``RUN`` at most."""
    breaks = np.concatenate([[True], np.diff(places) != 1])
    firsts = np.flatnonzero(breaks)
    within = np.arange(len(places)) - np.repeat(firsts, np.diff(np.append(firsts, len(places))))
    firsts = np.flatnonzero(within % RUN == 0)
    return firsts, np.diff(np.append(firsts, len(places)))


def merged(starts: np.ndarray, window: int) -> list[dict[str, int]]:
    """The union of the windows that start at ``starts`` (sorted), as spans of words."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > window) + 1
    first, last = starts[np.concatenate([[0], cuts])], starts[np.concatenate([cuts - 1, [len(starts) - 1]])]
    return [{"start": int(a), "end": int(b) + window} for a, b in zip(first, last, strict=True)]


def _signed(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """Each row's number of words, digest of its words and anchors; an anchor that recurs in the text is given twice."""

    def run(batches):
        for part in slices(batches):
            keys, anchors, lengths = [], [], []
            for text in part.column(2).to_pylist():
                words = split(text)
                lengths.append(len(words))
                if len(words) < window:
                    keys.append(None)
                    anchors.append(None)
                    continue
                keys.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
                runs = run_hashes(word_hashes(words), anchor)
                unique, n = np.unique(runs[np.unique(anchor_places(runs, window, anchor))], return_counts=True)
                anchors.append(np.repeat(unique, np.minimum(n, 2)).view(np.int64))
            yield pa.RecordBatch.from_arrays([
                *part.columns[:2], pa.array(lengths, pa.int32()), pa.array(keys, pa.binary()),
                pa.array(anchors, pa.list_(pa.int64())),
            ], ["row", "doc_id", "n_words", "key", "anchors"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"row long, doc_id {kind}, n_words int, key binary, anchors array<long>")


def _suffixes(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    """Merge the tasks' equal suffixes: repeats inside a task become ``spans`` of their row, the rest runs of consecutive suffixes.

    The ``words`` of a run are those that its suffixes cover; of rows with spans they are null.
    """
    kind = texts.schema["doc_id"].dataType
    names = ["row", "doc_id", "words", "start", "suffixes", "spans"]

    def run(batches):
        rows, ids, texts_, nodes, starts, owners = [], [], [], [], [], []
        vocabulary = Vocabulary()
        id_type = None

        def flush():
            if not rows:
                return
            order = sorted(range(len(rows)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0, rows[i]))
            rank = np.empty(len(rows), np.int64)
            rank[order] = np.arange(len(rows))
            flat, node = np.concatenate(texts_), np.concatenate(nodes)
            base = np.concatenate([[0], np.cumsum([len(t) for t in texts_])])
            start, owner = np.concatenate(starts), np.repeat(np.arange(len(rows)), owners)
            place = base[owner] + start
            walk = np.lexsort((start, rank[owner], node))
            same = np.flatnonzero(node[walk][1:] == node[walk][:-1])
            for k in range(window):  # equal hashes are not enough
                same = same[flat[place[walk[same + 1]] + k] == flat[place[walk[same]] + k]]
            first = np.ones(len(walk), bool)
            first[same + 1] = False
            repeats, kept = walk[~first], walk[first]
            repeats = repeats[np.lexsort((start[repeats], owner[repeats]))]
            bounds = np.searchsorted(owner[repeats], np.arange(len(rows) + 1))
            found = [merged(start[repeats[a:b]], window) for a, b in zip(bounds, bounds[1:], strict=False)]
            some = [i for i, spans in enumerate(found) if spans]
            for at in range(0, len(some), 2000):
                part = some[at : at + 2000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([rows[i] for i in part], pa.int64()), pa.array([ids[i] for i in part], id_type),
                    pa.nulls(len(part), pa.string()), pa.nulls(len(part), pa.int32()), pa.nulls(len(part), pa.int32()),
                    pa.array([found[i] for i in part], ARROW_SPANS),
                ], names)
            row_of, id_of = pa.array(rows, pa.int64()), pa.array(ids, id_type)
            shown = pa.array(vocabulary.shown, pa.binary()).cast(pa.string())
            kept = np.sort(kept)
            firsts, lengths = runs_of(place[kept]) if len(kept) else (kept, kept)
            for at in range(0, len(firsts), 1000):
                part, length = kept[firsts[at : at + 1000]], lengths[at : at + 1000]
                whose = pa.array(owner[part])
                yield pa.RecordBatch.from_arrays([
                    row_of.take(whose), id_of.take(whose), joined_words(shown, place[part], length + window - 1, flat),
                    pa.array(start[part].astype(np.int32)), pa.array(length.astype(np.int32)), pa.nulls(len(part), ARROW_SPANS),
                ], names)
            for held in (rows, ids, texts_, nodes, starts, owners, vocabulary, vocabulary.shown):
                held.clear()

        size = held_words = 0
        for batch in slices(batches):
            id_type = batch.schema.field("doc_id").type
            for row, doc_id, text, anchors in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = split(text)
                numbers = vocabulary.ids(words)
                hashes = word_hashes(words)
                runs = run_hashes(hashes, anchor)
                shared = np.isin(runs, np.array(anchors, np.int64).view(np.uint64))
                at = np.flatnonzero(shared[anchor_places(runs, window, anchor)])
                if not len(at):
                    continue
                rows.append(row)
                ids.append(doc_id)
                texts_.append(numbers)
                nodes.append(run_hashes(hashes, window)[at])
                starts.append(at)
                owners.append(len(at))
                size += len(at)
                held_words += len(words)
                if size > CHUNK or held_words > 8 * CHUNK or len(vocabulary) > CHUNK_WORDS:
                    yield from flush()
                    size = held_words = 0
        yield from flush()

    schema = f"row long, doc_id {kind.simpleString()}, words string, start int, suffixes int, spans {SPANS}"
    return texts.select("row", "doc_id", "text", "anchors").mapInArrow(run, schema)


def _expanded(runs: DataFrame, window: int, rounds: int = 1, number: int = 0) -> DataFrame:
    """Each suffix of the runs, with its ``window`` words; of several rounds, those whose first words' hash falls into round ``number``."""
    kind = runs.schema["doc_id"].dataType.simpleString()
    first_words = min(PREFIX_WORDS, window)

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                lists = pc.split_pattern(part.column("words"), " ")
                words, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy().astype(np.int64)
                counts = sizes - window + 1
                owner = np.repeat(np.arange(len(sizes)), counts)
                within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
                firsts = (np.cumsum(sizes) - sizes)[owner] + within
                if rounds > 1:
                    coded = words.dictionary_encode()
                    hashes = word_hashes([w.encode() for w in coded.dictionary.to_pylist()])[coded.indices.to_numpy()]
                    own = np.flatnonzero(run_hashes(hashes, first_words)[firsts] % np.uint64(rounds) == number)
                    if not len(own):
                        continue
                    owner, within, firsts = owner[own], within[own], firsts[own]
                whose = pa.array(owner)
                yield pa.RecordBatch.from_arrays([
                    joined_words(words, firsts, np.full(len(firsts), window)), part.column("doc_id").take(whose),
                    part.column("row").take(whose), pa.array((part.column("start").to_numpy()[owner] + within).astype(np.int32)),
                ], ["words", "doc_id", "row", "start"])

    return runs.select("row", "doc_id", "words", "start").mapInArrow(run, f"words string, doc_id {kind}, row long, start int")


def _prefix(words: int | Column) -> Column:
    """The hash of a suffix's first words; ``words`` may be a column."""
    count = F.lit(words) if isinstance(words, int) else words
    return F.xxhash64(F.call_function("substring_index", F.col("words"), F.lit(" "), count))


def crowded_prefixes(suffixes: DataFrame, store: Store, window: int) -> list[tuple[int, DataFrame]]:
    """The prefixes of ``PREFIX_WORDS`` words, and of each multiple of it below ``window``, whose suffixes hold over ``GROUP_BYTES``.

    A table of them has a row for each ``GROUP_BYTES`` of suffixes at most; how it is joined is left to Spark, which knows its size.
    """
    crowded = []
    for words in range(PREFIX_WORDS, window, PREFIX_WORDS):
        sizes = suffixes.groupBy(_prefix(words).alias("prefix")).agg(F.sum(F.octet_length("words")).alias("bytes"))
        large = store.put(f"prefixes-{words}", sizes.filter(F.col("bytes") > GROUP_BYTES).select("prefix"))
        if large.isEmpty():
            break
        crowded.append((words, large))
        suffixes = suffixes.withColumn("prefix", _prefix(words)).join(large, "prefix", "left_semi").drop("prefix")
    return crowded


def subtrees(suffixes: DataFrame, crowded: list[tuple[int, DataFrame]], window: int) -> DataFrame:
    """The suffixes with ``depth``, the words of the prefix that their subtree hangs from: the shortest that is not crowded, or the whole window."""
    placed = suffixes.withColumn("depth", F.lit(min(PREFIX_WORDS, window)))
    for words, large in crowded:
        longer = F.when(F.col("crowded") & (F.col("depth") == words), min(words + PREFIX_WORDS, window)).otherwise(F.col("depth"))
        placed = (
            placed.withColumn("prefix", _prefix(words)).join(large.withColumn("crowded", F.lit(True)), "prefix", "left")
            .withColumn("depth", longer).drop("prefix", "crowded")
        )
    return placed


def _walk(suffixes: DataFrame) -> DataFrame:
    """The leaves of deep nodes that are not the first of their node, for suffixes in order."""

    def run(batches):
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column(0)
            below = np.empty(batch.num_rows, bool)
            below[0] = words[0].as_py() == last
            below[1:] = pc.equal(words.slice(1), words.slice(0, len(words) - 1)).to_numpy(zero_copy_only=False)
            last = words[-1].as_py()
            yield batch.select(["row", "start"]).filter(pa.array(below))

    return suffixes.select("words", "row", "start").mapInArrow(run, "row long, start int")


def repeated_spans(docs: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(``row``, ``spans``): the spans of words of each row that windows with an earlier copy cover; rows without any are left out.

    ``row`` is the number that ``tables.numbered`` gives; spans may overlap.
    """
    store = Store(docs.sparkSession, "substrings")
    return _spans(_rows(docs, store), store, window, anchor)


def _rows(docs: DataFrame, store: Store) -> DataFrame:
    return pick(numbered(docs, store, "_substring_row"), "_substring_row", "doc_id", "text").toDF("row", "doc_id", "text")


def _spans(rows: DataFrame, store: Store, window: int, anchor: int) -> DataFrame:
    signed = store.put("signed", _signed(rows, window, anchor))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "anchors"))
    firsts = store.put("firsts", (
        signed.filter("key IS NOT NULL").groupBy("key").agg(first.alias("first")).select("key", "first.row", "first.anchors")
    ))
    under = firsts.select("row", F.explode("anchors").alias("anchor"))
    common = under.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    hits = store.put("hits", (
        under.distinct().join(common, "anchor").groupBy("row").agg(F.collect_list("anchor").alias("anchors"))
    ))
    copies = store.put("copies", (
        signed.filter("key IS NOT NULL").select("key", "row", "n_words")
        .join(firsts.select("key", F.col("row").alias("first_row")), "key").filter("row <> first_row")
        .select("row", F.struct(F.lit(0).alias("start"), F.col("n_words").alias("end")).alias("span"))
    ))
    n_words = signed.agg(F.sum(F.col("n_words").cast("long"))).first()[0] or 0
    store.free("signed", "firsts")
    store.settle()
    merged_in_tasks = store.put("merged", _suffixes(rows.join(hits, "row"), window, anchor))
    store.free("hits")
    store.settle()
    runs = merged_in_tasks.filter("words IS NOT NULL")
    crowded = crowded_prefixes(_expanded(runs, window), store, window)
    n_suffixes = runs.agg(F.sum("suffixes")).first()[0] or 0
    rounds = max(1, -(-n_suffixes * window // max(1, n_words)))
    across = []
    for number in range(rounds):
        suffixes = subtrees(_expanded(runs, window, rounds, number), crowded, window)
        in_order = (
            suffixes.repartition(_prefix(F.col("depth"))).select("words", "doc_id", "row", "start")
            .sortWithinPartitions("words", F.col("doc_id").asc_nulls_last(), "row", "start")
        )
        across.append(store.put(f"across-{number}", _walk(in_order)))
        store.settle()
    inside = merged_in_tasks.filter("words IS NULL").select("row", F.explode("spans").alias("span"))
    repeats = reduce(DataFrame.unionByName, across).select("row", F.struct("start", (F.col("start") + window).alias("end")).alias("span"))
    spans = copies.unionByName(inside).unionByName(repeats)
    found = store.put("spans", spans.groupBy("row").agg(F.collect_list("span").alias("spans")))
    store.free("merged", "copies", *(f"across-{number}" for number in range(rounds)))
    store.settle()
    return found


def remove_repeats(docs: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """One row for each document row: ``doc_id``, ``n_words``, ``n_removed`` and ``kept``, the words that stay, joined by blanks."""
    store = Store(docs.sparkSession, "substrings")
    rows = _rows(docs, store)
    spans = _spans(rows, store, window, anchor)
    joined = rows.join(spans, "row", "left").select("doc_id", "text", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for part in slices(batches):
            lengths, removed, kept = [], [], []
            for text, own in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                words = split(text)
                stays = np.ones(len(words), bool)
                for span in own or ():
                    stays[span["start"] : span["end"]] = False
                lengths.append(len(words))
                removed.append(len(words) - int(stays.sum()))
                kept.append(b" ".join(words if stays.all() else [words[i] for i in np.flatnonzero(stays).tolist()]))
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(lengths, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ], ["doc_id", "n_words", "n_removed", "kept"])

    return joined.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept string")


def digests(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )
