"""Line dedup: range-partitioned line hashes, sorted by document and place, give a keep bitmap for each document.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends and with A-Z lower-cased; the empty key is never repeated. Keys travel as
128-bit hashes with the id, digest and line number of their place, never as text. The places are range-partitioned by
(hash, id, digest, line) and sorted in that order, so a key that a third of all documents share is spread over as many tasks as its
places fill. Each task streams its runs of equal hashes: a run holds back its places only until it is known to be repeated. A run at a
partition's border may go on next door: such runs also tell their number of documents, at most two rows for each task, and the
places that they held back are settled by the sums.

The result is a bitmap for each document that loses lines, most significant bit first and compressed: a 1 keeps the line, lines after the last bit stay. Documents
are known by (id, 64-bit hash of id and text), the same in each read of the input; rows that agree in both are copies of one row with equal fates,
and each of them counts as a document.

Null and empty texts are one empty line and lose nothing. Null ids come first in the order. Very long texts are split
one at a time; a row cannot be cut. An empty table gives an empty result. Extra columns are left out by ``digests`` and kept by ``dedup_lines``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outlay.llm.tables import Store, pick, slices

PLACES = "h1 long, h2 long, doc_id long, digest long, line int, opens boolean"
# What a task says of a place: repeated for certain, held back at a border, or the first of its run at a border; SUM is a border run's size.
DROPPED, HELD, OPENER, SUM = 0, 1, 2, 3
RUNS = "h1 long, h2 long, doc_id long, digest long, line int, says int, part int, docs long"
ROWS = 20_000


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()]


def _places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each line with a key; ``opens`` marks the key's first place in its document."""
    for batch in slices(batches):
        owner, lines, opens, hashes = [], [], [], []
        for row, text in enumerate(_texts(batch)):
            seen: set[bytes] = set()
            for line, key in enumerate(map(bytes.strip, text.lower().split(b"\n"))):
                if key:
                    found = xxhash.xxh3_128_digest(key)
                    owner.append(row)
                    lines.append(line)
                    opens.append(found not in seen)
                    seen.add(found)
                    hashes.append(found)
        halves = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
        rows = pa.array(owner, pa.int64())
        columns = [
            pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()), batch.column(0).take(rows), batch.column(1).take(rows),
            pa.array(lines, pa.int32()), pa.array(opens, pa.bool_()),
        ]
        found = pa.RecordBatch.from_arrays(columns, ["h1", "h2", "doc_id", "digest", "line", "opens"])
        for start in range(0, len(owner), ROWS):
            yield found.slice(start, ROWS)


class _Run:
    """The run of equal hashes that is being read."""

    def __init__(self, key: tuple[int, int], border: bool):
        self.key, self.border, self.docs, self.held, self.started = key, border, 0, [], False


def _says(rows: pa.RecordBatch, says: int, part: int) -> pa.RecordBatch:
    n = rows.num_rows
    columns = [*rows.columns[:5], pa.array(np.full(n, says, np.int32)), pa.array(np.full(n, part, np.int32)), pa.nulls(n, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["h1", "h2", "doc_id", "digest", "line", "says", "part", "docs"])


def _decider(min_docs: int, keep_first: bool):
    """Stream sorted places; pass on the repeated ones, and of border runs what the neighbours must settle."""

    def closed(run: _Run, part: int, last: bool) -> Iterator[pa.RecordBatch]:
        if not (run.border or last):
            return
        for rows in run.held:
            yield _says(rows, HELD, part)
        sums = [[run.key[0]], [run.key[1]], [None], [None], [None], [SUM], [part], [run.docs]]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(sums, kinds, strict=True)],
            ["h1", "h2", "doc_id", "digest", "line", "says", "part", "docs"],
        )

    def fed(run: _Run, rows: pa.RecordBatch, docs: int, part: int) -> Iterator[pa.RecordBatch]:
        if keep_first and not run.started:
            # The first place stays, unless the run began in an earlier partition.
            if run.border:
                yield _says(rows.slice(0, 1), OPENER, part)
            rows = rows.slice(1)
        run.started = True
        run.docs += docs
        if run.docs < min_docs:
            run.held.append(rows)
            return
        for held in [*run.held, rows]:
            yield _says(held, DROPPED, part)
        run.held = []

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        current: _Run | None = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            h1, h2 = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            opens = batch.column(5).to_numpy(zero_copy_only=False).astype(np.int64)
            starts = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
            stops = np.append(starts[1:], n)
            docs = np.add.reduceat(opens, starts)
            # Whole runs inside the batch are settled at once; its first and last run may go on in other batches.
            inner = np.zeros(n, bool)
            for i in range(1, len(starts) - 1) if keep_first or len(starts) < 3 else ():
                if docs[i] >= min_docs:
                    inner[starts[i] + keep_first : stops[i]] = True
            if not keep_first and len(starts) > 2:
                inner[starts[1] : starts[-1]] = np.repeat(docs[1:-1] >= min_docs, (stops - starts)[1:-1])
            for i in sorted({0, len(starts) - 1}):
                key = (int(h1[starts[i]]), int(h2[starts[i]]))
                if current is None or current.key != key:
                    if current is not None:
                        yield from closed(current, part, False)
                    current = _Run(key, current is None)
                yield from fed(current, batch.slice(starts[i], stops[i] - starts[i]), int(docs[i]), part)
            if inner.any():
                yield _says(batch.filter(pa.array(inner)), DROPPED, part)
        if current is not None:
            yield from closed(current, part, True)

    return run


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compress the bitmap of each document."""
    for batch in batches:
        bitmaps = []
        for lines in batch.column(2).to_pylist():
            keep = np.ones((max(lines) // 8 + 1) * 8, bool)
            keep[lines] = False
            bitmaps.append(zlib.compress(np.packbits(keep).tobytes()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(bitmaps, pa.binary())], ["doc_id", "digest", "keep"])


def kept_lines(text: bytes, keep: bytes | None) -> tuple[list[bytes], int]:
    """The lines that a bitmap keeps, and the number of all lines."""
    lines = text.split(b"\n")
    if keep is None:
        return lines, len(lines)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[: len(lines)]
    gone = set(np.flatnonzero(bits == 0).tolist())
    return [line for i, line in enumerate(lines) if i not in gone], len(lines)


def _named(docs: DataFrame) -> DataFrame:
    """``doc_id`` and digest, by which a document is known, and its text."""
    found = pick(docs, "doc_id", "text")
    doc_id = F.col("doc_id").cast("long")
    return found.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, "text").alias("digest"), "text")


def keep_bitmaps(docs: DataFrame, min_docs: int = 2, keep: str = "first") -> DataFrame:
    """(``doc_id``, ``digest``, ``keep``) of the documents that lose lines.

    Of a key that ``min_docs`` documents or more hold, all lines go but the first (``keep="first"``: by id, digest and place), or all (``"none"``).
    With ``"first"``, repeats inside one document go from ``min_docs=1`` on.
    """
    if keep not in ("first", "none"):
        raise ValueError("keep is 'first' or 'none'")
    if min_docs < 1:
        raise ValueError("min_docs is 1 or more")
    order = ["h1", "h2", "doc_id", "digest", "line"]
    places = _named(docs).mapInArrow(_places, PLACES).repartitionByRange(*order).sortWithinPartitions(*order)
    runs = Store(docs.sparkSession, "lines").put("runs", places.mapInArrow(_decider(min_docs, keep == "first"), RUNS))
    sums = (
        runs.filter(F.col("says") == SUM).groupBy("h1", "h2")
        .agg(F.sum("docs").alias("all_docs"), F.min("part").alias("first_part"))
    )
    open_runs = runs.filter(F.col("says").isin(HELD, OPENER)).join(sums, ["h1", "h2"])
    opener = F.col("says") == OPENER
    settled = open_runs.filter((F.col("all_docs") >= min_docs) & (~opener | (F.col("part") > F.col("first_part"))))
    dropped = runs.filter(F.col("says") == DROPPED).unionByName(settled.select(*runs.columns))
    return (
        dropped.groupBy("doc_id", "digest").agg(F.collect_set("line").alias("lines"))
        .mapInArrow(_packed, "doc_id long, digest long, keep binary")
    )


def _with_bitmaps(named: DataFrame, bitmaps: DataFrame) -> DataFrame:
    found = bitmaps.toDF("_doc", "_digest", "_keep")
    return named.join(found, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("digest") == F.col("_digest")), "left")


def dedup_lines(docs: DataFrame, min_docs: int = 2, keep: str = "first") -> DataFrame:
    """``docs`` with the kept lines as text; null texts stay null, and all other columns stay as they are."""
    names = docs.columns
    places = {name: next(i for same in (lambda c, n=name: c == n, lambda c, n=name: c.lower() == n)
                         for i, c in enumerate(names) if same(c)) for name in ("doc_id", "text")}
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text, doc_id = f"c{places['text']}", F.col(f"c{places['doc_id']}").cast("long")
    named = plain.withColumns({"doc_id": doc_id, "digest": F.xxhash64(doc_id, text)})
    joined = _with_bitmaps(named, keep_bitmaps(docs, min_docs, keep)).drop("doc_id", "digest", "_doc", "_digest")
    columns_out, at = plain.columns, plain.columns.index(text)

    def run(batches):
        for batch in slices(batches, text):
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            keeps = batch.column(len(names)).to_pylist()
            kept = [None if t is None else b"\n".join(kept_lines(t, k)[0]) for t, k in zip(texts, keeps, strict=True)]
            columns = batch.columns[: len(names)]
            columns[at] = pa.array(kept, pa.binary()).cast(batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=columns_out)

    return joined.mapInArrow(run, plain.schema).toDF(*names)


def _digested(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        totals, dropped, hashes = [], [], []
        for text, keep in zip(_texts(batch), batch.column(2).to_pylist(), strict=True):
            kept, n = kept_lines(text, keep)
            totals.append(n)
            dropped.append(n - len(kept))
            hashes.append(hashlib.sha256(b"\n".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(totals, pa.int64()), pa.array(dropped, pa.int64()), pa.array(hashes)],
            ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )


def digests(docs: DataFrame, min_docs: int, keep: str = "none") -> DataFrame:
    """For each document its number of lines, how many are dropped, and the hash of the rest."""
    joined = _with_bitmaps(_named(docs), keep_bitmaps(docs, min_docs, keep)).select("doc_id", "text", "_keep")
    return joined.mapInArrow(_digested, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
