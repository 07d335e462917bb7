"""Byte-level BPE encoding and decoding with an existing rank file.

A text is cut by the tokenizer's pattern, and each distinct piece is encoded once. Pieces of
similar length form one padded matrix of token ids; in every round each row merges its leftmost
pair of least rank, and the row is closed up. Pair ranks come from an open-addressing hash table
of the pairs. Pieces over ``LONG`` bytes use the same table with a heap, as rounds over wide
rows would cost the square of their length.

Null texts count as empty, and empty texts give no tokens. Every text is encoded whole; repeated
rows give repeated results; ids may be null or repeat. Invalid code points (lone surrogates)
cannot occur in a Spark string. Columns other than those named are left out.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from outlay.llm.tables import pick, slices

NONE = np.int32(2**31 - 1)
PAD = np.int32(-1)
LONG = 256
CACHE = 300_000  # pieces that a Python worker remembers
MATRIX_CELLS = 1_000_000
SLICE = 1 << 20
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """(left id, right id) -> rank of the joined token: linear probing over numpy arrays, many keys at once."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[(left << 32) | right] = rank
        bits = max(4, (3 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NONE, np.int32)
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == -1
            self.keys[slots[free]] = keys[free]  # of several in one slot the last stays
            placed = self.keys[slots] == keys
            self.ranks[slots[placed]] = values[placed]
            keys, values, slots = keys[~placed], values[~placed], (slots[~placed] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * GOLDEN) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; ``NONE`` for pairs that do not merge or that touch the padding."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        out = np.full(keys.shape, NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = keys.ravel()[todo]
        slots = self._slots(keys)
        flat = out.ravel()
        while len(todo):
            seen = self.keys[slots]
            hit = seen == keys
            flat[todo[hit]] = self.ranks[slots[hit]]
            on = ~hit & (seen != -1)
            todo, keys, slots = todo[on], keys[on], (slots[on] + 1) & self.mask
        return out


def read_ranks(rank_file: bytes) -> dict[bytes, int]:
    lines = (line.split() for line in rank_file.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in lines}


class ByteBpe:
    """One rank file: ``encode_pieces`` for byte strings, ``encode`` for texts."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.ranks = read_ranks(rank_file)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.table = PairTable(self.ranks)
        self.first = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.findall = regex.compile(pattern).findall
        self._forget()

    def encode_pieces(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        out: list[tuple[int, ...]] = [()] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = (whole,)
            elif len(piece) > LONG:
                out[i] = self._merge_long(piece)
            elif piece:
                buckets.setdefault(-(-len(piece) // 4) * 4, []).append(i)
        for width, rows in buckets.items():
            step = max(1, MATRIX_CELLS // width)
            for start in range(0, len(rows), step):
                part = rows[start : start + step]
                for i, ids in zip(part, self._merge_matrix([pieces[i] for i in part], width), strict=True):
                    out[i] = ids
        return out

    def _merge_matrix(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        ids = np.where(np.arange(width) < sizes[:, None], self.first[raw], PAD)
        ids = np.concatenate([ids, np.full((len(ids), 1), PAD, np.int32)], axis=1)  # the last column stays empty
        ranks = self.table.find(ids[:, :-1], ids[:, 1:])
        out: list[tuple[int, ...]] = [()] * len(pieces)
        rows = np.arange(len(pieces))
        while len(rows):
            at = ranks.argmin(axis=1)  # the leftmost of the least
            best = ranks[np.arange(len(rows)), at]
            done = best == NONE
            if done.any():
                for row, line, n in zip(rows[done], ids[done].tolist(), sizes[done].tolist(), strict=True):
                    out[row] = tuple(line[:n])
                rows, ids, ranks, at, best, sizes = (x[~done] for x in (rows, ids, ranks, at, best, sizes))
                if not len(rows):
                    break
            every, sizes = np.arange(len(rows)), sizes - 1
            columns = np.arange(ids.shape[1] - 1)
            ids[every, at] = best
            ids[:, :-1] = np.take_along_axis(ids, columns + (columns > at[:, None]), axis=1)
            ids[:, -1] = PAD
            columns = np.arange(ranks.shape[1] - 1)
            ranks[:, :-1] = np.take_along_axis(ranks, columns + (columns > at[:, None]), axis=1)
            ranks[:, -1] = NONE
            ranks[every, at] = self.table.find(best, ids[every, at + 1])
            left = np.maximum(at - 1, 0)
            before = self.table.find(ids[every, left], best)
            ranks[every, left] = np.where(at > 0, before, ranks[every, left])
            used = int(sizes.max()) + 1
            if used < ids.shape[1] // 2:
                ids, ranks = ids[:, : used + 1].copy(), ranks[:, :used].copy()
        return out

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same merges over a linked list, with a heap of (rank, place)."""
        ids = self.first[np.frombuffer(piece, np.uint8)]
        ranks = self.table.find(ids[:-1], ids[1:])
        heap = [(rank, i) for i, rank in enumerate(ranks.tolist()) if rank != NONE]
        heapq.heapify(heap)
        ids = ids.tolist()
        after = list(range(1, len(ids))) + [-1]
        before = list(range(-1, len(ids) - 1))
        get = self._pair
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or get(ids[i], ids[j]) != rank:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
                if (r := get(rank, ids[after[i]])) is not None:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0 and (r := get(ids[before[i]], rank)) is not None:
                heapq.heappush(heap, (r, before[i]))
        return tuple(i for i in ids if i >= 0)

    def _pair(self, left: int, right: int) -> int | None:
        return self.ranks.get(self.tokens[left] + self.tokens[right])

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.known, self.bounds, self.used = np.zeros(1024, np.int32), np.zeros(1, np.int64), 0

    def _learn(self, pieces: list[str]) -> None:
        """Number the new pieces and append their ids to the known ones."""
        found = self.encode_pieces([p.encode() for p in pieces])
        self.index.update(zip(pieces, range(len(self.index), len(self.index) + len(pieces)), strict=True))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        end = self.used + int(sizes.sum())
        if len(self.index) >= len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros(2 * len(self.index), np.int64)])
        self.bounds[len(self.index) - len(pieces) + 1 : len(self.index) + 1] = self.used + np.cumsum(sizes)
        if end > len(self.known):
            self.known = np.concatenate([self.known, np.zeros(2 * end, np.int32)])
        self.known[self.used : end] = np.fromiter(chain.from_iterable(found), np.int32, end - self.used)
        self.used = end

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's ids start and end."""
        split = [self.findall(text) if text else [] for text in texts]
        pieces = list(chain.from_iterable(split))
        places = np.fromiter(map(self.index.get, pieces, repeat(-1)), np.int64, len(pieces))
        if (missing := np.flatnonzero(places < 0)).size:
            new = {pieces[i] for i in missing.tolist()}
            if len(self.index) + len(new) > CACHE:  # start anew, with all that this call needs
                self._forget()
                new, missing = set(pieces), np.arange(len(pieces))
            self._learn(list(new))
            found = map(self.index.__getitem__, map(pieces.__getitem__, missing.tolist()))
            places[missing] = np.fromiter(found, np.int64, len(missing))
        starts, sizes = self.bounds[places], self.bounds[places + 1] - self.bounds[places]
        ends = np.cumsum(sizes)
        values = self.known[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        per_text = np.cumsum([0, *map(len, split)])
        return values, np.concatenate([[0], ends])[per_text]


@lru_cache(maxsize=2)
def load(rank_file: bytes, pattern: str) -> ByteBpe:
    """The tokenizer, built once in each Python worker."""
    return ByteBpe(rank_file, pattern)


def encode(docs: DataFrame, rank_file: bytes, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of each row and ``ids``, the token ids of its ``text``.

    ``rank_file`` is the content of a rank file (base64 token and rank on each line), broadcast
    to the tasks: its size is the vocabulary's.
    """
    source = pick(docs, *keep, "text").withColumnRenamed("text", "_text")
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])
    shared = docs.sparkSession.sparkContext.broadcast(rank_file)

    def run(batches):
        bpe = load(shared.value, pattern)
        for part in slices(batches, "_text", SLICE):
            values, bounds = bpe.encode(part.column(len(keep)).to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))
            yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], lists], [*keep, "ids"])

    return source.mapInArrow(run, schema)


@lru_cache(maxsize=2)
def _tokens(rank_file: bytes) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(rank_file).items()}


def decode_ids(ids: list[int] | None, rank_file: bytes) -> bytes:
    """The bytes of the tokens in a row; an id that the vocabulary lacks is an error."""
    return b"".join(map(_tokens(rank_file).__getitem__, ids or ()))


def decode(encoded: DataFrame, rank_file: bytes, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of each row and ``decoded``, the bytes that its ``ids`` stand for (null ids: none)."""
    source = pick(encoded, *keep, "ids").withColumnRenamed("ids", "_ids")
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("decoded", T.BinaryType(), False)])
    shared = encoded.sparkSession.sparkContext.broadcast(rank_file)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                decoded = pa.array([decode_ids(ids, shared.value) for ids in part.column(len(keep)).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], decoded], [*keep, "decoded"])

    return source.mapInArrow(run, schema)


def digests(docs: DataFrame, rank_file: bytes, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``n_tokens``, and the digests of each text's ids and of the bytes that these ids decode to.

    Both steps run in one pass over the rows, so ids need not leave the Python worker.
    """
    source = pick(docs, *keep, "text").withColumnRenamed("text", "_text")
    names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256"]
    schema = T.StructType([
        *source.schema.fields[:-1], T.StructField("n_tokens", T.LongType(), False),
        T.StructField("ids_sha256", T.StringType(), False), T.StructField("decoded_sha256", T.StringType(), False),
    ])
    shared = docs.sparkSession.sparkContext.broadcast(rank_file)

    def run(batches):
        bpe = load(shared.value, pattern)
        for part in slices(batches, "_text", SLICE):
            values, bounds = bpe.encode(part.column(len(keep)).to_pylist())
            listed = [values[a:b].tolist() for a, b in zip(bounds.tolist(), bounds[1:].tolist(), strict=False)]
            columns = (
                pa.array(np.diff(bounds), pa.int64()),
                pa.array([hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() for ids in listed], pa.string()),
                pa.array([hashlib.sha256(decode_ids(ids, shared.value)).hexdigest() for ids in listed], pa.string()),
            )
            yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *columns], names)

    return source.mapInArrow(run, schema)
