"""Language-model scores from a subword lattice.

The pieces are those of an existing vocabulary, and their first scores come from its order: piece number r
weighs 1 / (r + ``RANK_SHIFT``). A word, with a blank before it, is read as a piece that starts with the blank, any number of
other pieces, and a stop; every segmentation of the word into pieces counts. A forward recursion in log space
over the ends of the pieces gives the word's marginal probability. ``rounds`` expectation steps over all
words of the training texts, each with its count, turn the first scores into the corpus's own.

Texts come in classes, one for each language of at least ``CLASS_SHARE`` of the training texts and one for all other
training texts; each class has its own piece scores and word counts. The lattice of a word has one more arc: the whole word, as
the class's texts have it. A word seen ``c`` times among the ``N`` tokens of a class, ``V`` of them distinct, has the probability
(c + V * L) / (N + V), where L is the marginal of its pieces; so words never seen get their share from their pieces, and
all probabilities sum to one. A text is a class, its words and one end, which is a token without pieces; its probability is
the product, summed over the classes.

Words are bytes other than ASCII white space, with A-Z in lower case. Null texts count as empty and have the end alone.
Repeated rows are scored each, and count in training as often as they occur. Null ids are allowed, and a null language counts among the others. Without training
texts N and V are 0: the whole weight is on the pieces, and the end has log probability 0. Extra columns are left out. The
language is never looked at when a text is scored.

Word counts are summed in tasks, then by word. Words with a share of ``HEAVY`` of all tokens, at most 1 / ``HEAVY`` by
definition, are broadcast; the other words of each text are joined to the word table. Both give a sum for each class, so the
share decides the plan alone. Words of over ``LONG`` bytes are read in stretches, so memory follows their bytes and not the arcs.
"""

from __future__ import annotations

import base64
import math
from array import array
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outlay.llm.tables import Store, pick, slices

RANK_SHIFT = 50
ROUNDS = 2
CLASS_SHARE = 1 / 64
HEAVY = 1e-6
PRIOR = 0.01
CELLS = 2_000_000
LONG = 1 << 14
HELD = 400_000
BASE = np.uint64(0x100000001B3)
MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str | None) -> list[bytes]:
    """The words of a text, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def _mixed(hashes: np.ndarray, length: int) -> np.ndarray:
    out = (hashes + np.uint64(length)) * MIX
    return out ^ (out >> np.uint64(32))


def _prefix_hashes(raw: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the prefixes of each row of bytes; column 0 is the empty prefix."""
    out = np.zeros((raw.shape[0], raw.shape[1] + 1), np.uint64)
    for j in range(raw.shape[1]):
        out[:, j + 1] = out[:, j] * BASE + raw[:, j] + np.uint64(1)
    return out


@dataclass
class Pieces:
    """The vocabulary's pieces by hash, with a natural log score each.

    ``starts`` tells which pieces begin with the blank and so begin a word; ``slots`` has the pieces' places by hash, each in the
    first free slot from its own on.
    """

    hashes: np.ndarray
    starts: np.ndarray
    scores: np.ndarray
    longest: int
    stop: float
    slots: np.ndarray

    @classmethod
    def from_ranks(cls, rank_file: bytes) -> Pieces:
        """The pieces of a rank file (base64 token and rank on each line) that can occur in a word, scored by rank."""
        hashes, starts, weights, longest = [], [], [], 1
        for line in rank_file.splitlines():
            token, rank = line.split()
            token = base64.b64decode(token)
            if len((token[1:] if token[:1] == b" " else token).split()) > 1 or token[1:].strip() != token[1:] or (
                token[:1].isspace() and token[:1] != b" "
            ):
                continue
            raw = np.frombuffer(token, np.uint8).astype(np.uint64)[None, :]
            hashes.append(_mixed(_prefix_hashes(raw)[:, -1], len(token))[0])
            starts.append(token[:1] == b" ")
            weights.append(1 / (int(rank) + RANK_SHIFT))
            longest = max(longest, len(token))
        order = np.argsort(np.array(hashes, np.uint64))
        hashes = np.array(hashes, np.uint64)[order]
        made = cls(hashes, np.array(starts)[order], np.zeros(len(order)), longest, 0.0, _slots(hashes))
        return made.weighted(np.array(weights)[order], None)

    def weighted(self, weights: np.ndarray, words: float | None) -> Pieces:
        """Scores in proportion to ``weights``: of starting pieces among themselves, of others with ``words`` stops."""
        stops = float(weights[~self.starts].sum()) if words is None else words + PRIOR
        totals = np.where(self.starts, weights[self.starts].sum(), weights[~self.starts].sum() + stops)
        stop = np.log(stops / (weights[~self.starts].sum() + stops))
        return Pieces(self.hashes, self.starts, np.log(weights / totals), self.longest, float(stop), self.slots)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        mask = np.uint64(len(self.slots) - 1)
        flat = hashes.ravel()
        slot = (flat & mask).astype(np.int64)
        found = self.slots[slot]
        # Of the slots that hold another piece, look at the next one.
        left = np.flatnonzero((found >= 0) & (self.hashes[found] != flat))
        while len(left):
            slot[left] = (slot[left] + 1) & int(mask)
            found[left] = self.slots[slot[left]]
            left = left[(found[left] >= 0) & (self.hashes[found[left]] != flat[left])]
        return found.reshape(hashes.shape)

    def _arcs(self, raw: np.ndarray) -> np.ndarray:
        """For each word, end and length the piece's place, or -1: shape (words, ends, lengths)."""
        n, width = raw.shape
        most = min(width, self.longest)
        prefix = _prefix_hashes(raw)
        out = np.full((n, width + 1, most + 1), -1, np.int32)
        power = np.ones(1, np.uint64)
        for length in range(1, most + 1):
            power = power * BASE
            found = _mixed(prefix[:, length:] - prefix[:, :-length] * power, length)
            out[:, length:, length] = self._find(found)
        return out

    def _forward(self, scores: np.ndarray) -> np.ndarray:
        """Log sums over the segmentations of each prefix; column 0 is the empty one."""
        n, ends, lengths = scores.shape
        alpha = np.full((n, ends), -np.inf)
        alpha[:, 0] = 0
        for end in range(1, ends):
            most = min(end, lengths - 1)
            alpha[:, end] = _log_sum(alpha[:, end - most : end][:, ::-1] + scores[:, end, 1 : most + 1])
        return alpha

    def _scored(self, arcs: np.ndarray) -> np.ndarray:
        return np.where(arcs >= 0, self.scores[arcs], -np.inf)

    def marginals(self, words: list[bytes], others: tuple[Pieces, ...] = ()) -> np.ndarray:
        """The natural log of each word's probability by its pieces: a column for these scores and each of ``others``."""
        out = np.empty((len(words), 1 + len(others)))
        for place, word in _long(words):
            for k, own in enumerate((self, *others)):
                out[place, k] = own._long_forward(word)[-1] + own.stop
        for places, raw in _matrices(words, self.longest):
            arcs = self._arcs(raw)
            for k, own in enumerate((self, *others)):
                out[places, k] = own._forward(own._scored(arcs))[:, -1] + own.stop
        return out

    def expected(self, words: list[bytes], counts: np.ndarray, own: tuple[Pieces, ...] = ()) -> np.ndarray:
        """How often each piece is used in the words, by the probabilities of their segmentations: a row for each column of ``counts``.

        ``own`` has the scores for each column; without it these scores are all columns'. The arcs are found once for all.
        """
        out = np.zeros((counts.shape[1], len(self.hashes)))
        for place, word in _long(words):
            for k in np.flatnonzero(counts[place]).tolist():
                out[k] += counts[place, k] * (own[k] if own else self)._long_expected(word)
        for places, raw in _matrices(words, self.longest):
            arcs = self._arcs(raw)
            if not own:
                used, shares, word = self._used(arcs)
                for k, n in enumerate(counts[places].T):
                    out[k] += np.bincount(used, weights=shares * n[word], minlength=len(self.hashes))
                continue
            for k, scores in enumerate(own):
                seen = np.flatnonzero(counts[places, k])
                if len(seen):
                    used, shares, word = scores._used(arcs[seen])
                    out[k] += np.bincount(used, weights=shares * counts[places[seen], k][word], minlength=len(self.hashes))
        return out

    def _used(self, arcs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each arc its piece, the probability that a segmentation has it, and its word."""
        scores = self._scored(arcs)
        alpha = self._forward(scores)
        n, ends, lengths = scores.shape
        beta = np.full((n, ends), -np.inf)
        beta[:, -1] = 0
        for start in range(ends - 2, -1, -1):
            most = min(ends - 1 - start, lengths - 1)
            steps = np.arange(1, most + 1)
            beta[:, start] = _log_sum(beta[:, start + steps] + scores[:, start + steps, steps])
        word, end, length = np.nonzero(arcs >= 0)
        share = np.exp(alpha[word, end - length] + scores[word, end, length] + beta[word, end] - alpha[word, -1])
        return arcs[word, end, length], share, word

    def _stretches(self, word: bytes, backwards: bool = False):
        """The arcs (start, end, piece) of one long word in stretches of starts, in the order of their starts."""
        raw = np.frombuffer(b" " + word, np.uint8).astype(np.uint64)
        starts = range(0, len(raw), LONG)
        for first in reversed(starts) if backwards else starts:
            arcs = self._arcs(raw[None, first : first + LONG + self.longest])[0]
            end, length = np.nonzero(arcs >= 0)
            start = end - length
            inside = np.flatnonzero(start < LONG)
            inside = inside[np.argsort(start[inside], kind="stable")]
            end, length, start = end[inside], length[inside], start[inside]
            yield first + start, first + end, arcs[end, length]

    def _long_forward(self, word: bytes) -> array:
        alpha = array("d", [-math.inf]) * (len(word) + 2)
        alpha[0] = 0.0
        for starts, ends, pieces in self._stretches(word):
            for s, e, v in zip(starts.tolist(), ends.tolist(), self.scores[pieces].tolist(), strict=True):
                alpha[e] = _log_add(alpha[e], alpha[s] + v)
        return alpha

    def _long_expected(self, word: bytes) -> np.ndarray:
        alpha, out = np.array(self._long_forward(word)), np.zeros(len(self.hashes))
        beta = array("d", [-math.inf]) * len(alpha)
        beta[-1] = 0.0
        for starts, ends, pieces in self._stretches(word, backwards=True):
            scores = self.scores[pieces]
            for s, e, v in zip(starts[::-1].tolist(), ends[::-1].tolist(), scores[::-1].tolist(), strict=True):
                beta[s] = _log_add(beta[s], beta[e] + v)
            share = np.exp(alpha[starts] + scores + np.array([beta[e] for e in ends.tolist()]) - alpha[-1])
            out += np.bincount(pieces, weights=share, minlength=len(out))
        return out


def _slots(hashes: np.ndarray) -> np.ndarray:
    """Places by hash, in four to eight times as many slots; -1 is a free one."""
    size = 4 << max(1, len(hashes)).bit_length()
    slots = np.full(size, -1, np.int32)
    left, slot = np.arange(len(hashes)), (hashes & np.uint64(size - 1)).astype(np.int64)
    while len(left):
        free = slots[slot[left]] < 0
        chosen, first = np.unique(slot[left[free]], return_index=True)
        slots[chosen] = left[free][first]
        left = left[slots[slot[left]] != left]
        slot[left] = (slot[left] + 1) & (size - 1)
    return slots


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def _long(words: list[bytes]) -> list[tuple[int, bytes]]:
    return [(i, word) for i, word in enumerate(words) if len(word) >= LONG]


def _log_sum(values: np.ndarray) -> np.ndarray:
    top = values.max(axis=1)
    safe = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.exp(values - safe[:, None]).sum(axis=1))


def _matrices(words: list[bytes], longest: int):
    """Words of one length at a time, but for long ones, as a matrix of bytes, a blank before each, in parts of bounded size."""
    by_length: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        if len(word) < LONG:
            by_length.setdefault(len(word) + 1, []).append(i)
    for width, places in by_length.items():
        step = max(1, CELLS // (width * min(width, longest)))
        for start in range(0, len(places), step):
            part = places[start : start + step]
            joined = b"".join(b" " + words[i] for i in part)
            yield np.array(part), np.frombuffer(joined, np.uint8).reshape(len(part), width).astype(np.uint64)


def _counts(classes: int) -> list[str]:
    return [f"c{k}" for k in range(classes)]


def _scores(classes: int) -> list[str]:
    return [f"score{k}" for k in range(classes)]


def _count_words(docs: DataFrame, classes: int) -> DataFrame:
    """``word``, its counts ``c0``, ... in the rows of each class, and ``other``: its count in rows without a class."""
    names = [*_counts(classes), "other"]

    def run(batches):
        held: list[Counter] = [Counter() for _ in names]

        def flush():
            for which, counter in enumerate(held):
                words, counts = list(counter), np.fromiter(counter.values(), np.int64, len(counter))
                for at in range(0, len(words), 20_000):
                    part = counts[at : at + 20_000]
                    columns = [pa.array(part if k == which else np.zeros_like(part)) for k in range(len(names))]
                    yield pa.RecordBatch.from_arrays([pa.array(words[at : at + 20_000], pa.binary()), *columns], ["word", *names])
                counter.clear()

        for part in slices(batches):
            for which, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                held[which].update(tokens(text))
            if sum(map(len, held)) > HELD:
                yield from flush()
        yield from flush()

    counted = docs.select("class", "text").mapInArrow(run, "word binary, " + ", ".join(f"{n} long" for n in names))
    return counted.groupBy("word").agg(*[F.sum(n).alias(n) for n in names])


@dataclass
class Totals:
    """``tokens`` (N), ``distinct`` (V) and ``ends`` of some texts."""

    tokens: int
    distinct: int
    ends: int

    def base(self, c: np.ndarray) -> np.ndarray:
        """log10 of the add-one probability of a token seen ``c`` times."""
        return np.log10((c + 1) / (self.tokens + self.distinct + 1))

    def score(self, c: np.ndarray, marginals: np.ndarray) -> np.ndarray:
        """log10 of the lattice's probability of a token seen ``c`` times; ``marginals`` are natural logs."""
        if not self.tokens:
            return marginals / np.log(10)
        with np.errstate(divide="ignore"):
            both = np.logaddexp(np.log(c), np.log(self.distinct) + marginals)
        return (both - np.log(self.tokens + self.distinct)) / np.log(10)

    @property
    def end_score(self) -> float:
        return float(np.log10(self.ends / (self.tokens + self.distinct))) if self.tokens else 0.0


def _matrix(part: pa.RecordBatch, classes: int) -> np.ndarray:
    """The counts of a batch of words, a column for each class."""
    return np.stack([part.column(1 + k).to_numpy() for k in range(classes)], axis=1).astype(float)


def _fit(words: DataFrame, first: Pieces, totals: list[Totals], rounds: int) -> tuple[Pieces, ...]:
    """Each class's pieces, scored by ``rounds`` expectation steps over all its words.

    The driver gets one sum for each class and piece of the vocabulary.
    """
    spark, classes = words.sparkSession, len(totals)
    pieces = (first,) * classes
    for turn in range(rounds if any(t.tokens for t in totals) else 0):
        shared = spark.sparkContext.broadcast(pieces)

        def run(batches, turn=turn, shared=shared):
            own = shared.value
            sums = np.zeros((classes, len(own[0].hashes)))
            for part in slices(batches, "word", 1 << 19):
                listed, counts = part.column(0).to_pylist(), _matrix(part, classes)
                if not turn:  # all classes still have the same scores
                    seen = np.flatnonzero(counts.any(axis=1))
                    sums += own[0].expected([listed[i] for i in seen.tolist()], counts[seen])
                    continue
                seen = np.flatnonzero(counts.any(axis=1))
                sums += own[0].expected([listed[i] for i in seen.tolist()], counts[seen], own)
            which, piece = np.nonzero(sums)
            yield pa.RecordBatch.from_pydict({
                "class": which.astype(np.int32), "piece": piece.astype(np.int32), "n": sums[which, piece],
            })

        found = words.mapInArrow(run, "class int, piece int, n double").groupBy("class", "piece").agg(F.sum("n").alias("n")).toArrow()
        weights = np.full((classes, len(first.hashes)), PRIOR)
        weights[found.column("class").to_numpy(), found.column("piece").to_numpy()] += found.column("n").to_numpy()
        pieces = tuple(first.weighted(weights[k], float(totals[k].tokens - totals[k].ends)) for k in range(classes))
    return pieces


def _score_words(words: DataFrame, pieces: tuple[Pieces, ...], totals: list[Totals], whole: Totals) -> DataFrame:
    """Every word with its count over all texts, whether it is known, its base, and its log10 probability in each class."""
    shared = words.sparkSession.sparkContext.broadcast((pieces, totals, whole))

    def run(batches):
        own, of, every = shared.value
        for part in slices(batches, "word", 1 << 19):
            counts = _matrix(part, len(of))
            marginals = own[0].marginals(part.column(0).to_pylist(), own[1:])
            scores = np.stack([t.score(counts[:, k], marginals[:, k]) for k, t in enumerate(of)], axis=1)
            c = counts.sum(axis=1)
            yield pa.RecordBatch.from_arrays([
                part.column(0), pc.add(pa.array(c.astype(np.int64)), part.column("other")), pa.array((c > 0).astype(np.int8)),
                pa.array(every.base(c)), pa.ListArray.from_arrays(
                    pa.array(np.arange(len(c) + 1, dtype=np.int32) * len(of)), pa.array(scores.ravel())
                ),
            ], ["word", "uses", "known", "base", "scores"])

    return words.mapInArrow(run, "word binary, uses long, known byte, base double, scores array<double>")


def _score_heavy(docs: DataFrame, heavy: pa.Table, totals: list[Totals], whole: Totals) -> DataFrame:
    """For each row the sums over its end and its heavy words, the scores by class, and its other words with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)
    end = (int(whole.ends > 0), float(whole.base(np.float64(whole.ends))))
    names = _scores(len(totals))
    classes = np.array([(np.log10(t.ends / whole.ends) if whole.ends else 0.0) + t.end_score for t in totals])

    def run(batches):
        table = shared.value
        place = dict(zip(table.column("word").to_pylist(), range(table.num_rows), strict=True))
        scores = np.array(table.column("scores").to_pylist(), float).reshape(-1, len(classes)).T
        values = np.vstack([table.column("known").to_numpy(), table.column("base").to_numpy(), scores])
        values = np.hstack([values, np.zeros((len(values), 1))])  # for the words that are not there
        for part in slices(batches):
            sums, lengths, words, uses, sizes = [], [], [], [], [0]
            for text in part.column(2).to_pylist():
                counted = Counter(tokens(text))
                n = np.fromiter(counted.values(), np.int64, len(counted))
                at = np.fromiter(map(place.get, counted, repeat(-1)), np.int64, len(counted))
                sums.append(values[:, at] @ n)
                lengths.append(int(n.sum()) + 1)
                rare = np.flatnonzero(at < 0)
                listed = list(counted)
                words += [listed[i] for i in rare.tolist()]
                uses.append(n[rare])
                sizes.append(len(rare))
            known, base, *scored = np.array(sums).T
            scored = np.stack(scored, axis=1) + classes
            yield pa.RecordBatch.from_arrays([
                *part.columns[:2], pa.array(lengths, pa.int64()), pa.array(known.astype(np.int64) + end[0]),
                pa.array(base + end[1]), *map(pa.array, scored.T),
                pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), pa.StructArray.from_arrays(
                    [pa.array(words, pa.binary()), pa.array(np.concatenate(uses).astype(np.int32))], ["word", "n"]
                )),
            ], ["row", "doc_id", "n_tokens", "n_known", "base", *names, "rare"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, (
        f"row long, doc_id {kind}, n_tokens long, n_known long, base double, {', '.join(f'{n} double' for n in names)}, "
        "rare array<struct<word: binary, n: int>>"
    ))


def score_texts(
    docs: DataFrame, training: Column, rank_file: bytes, *, rounds: int = ROUNDS, heavy: float = HEAVY, class_share: float = CLASS_SHARE,
) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    ``training`` is a condition on ``doc_id``: the rows that the model learns from. ``docs`` must be a stored table.
    """
    spark = docs.sparkSession
    store = Store(spark, "lattice")
    texts = pick(docs, "doc_id", "lang", "text")
    train = F.coalesce(training, F.lit(False))
    by_language = texts.filter(train).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    ends = by_language.agg(F.sum("n")).first()[0] or 0
    # At most 1 / class_share languages by definition.
    named = sorted((r["lang"], r["n"]) for r in by_language.filter(F.col("lang").isNotNull() & (F.col("n") >= class_share * ends)).collect())
    sizes = [n for _, n in named]
    if sum(sizes) < ends or not sizes:
        sizes.append(ends - sum(sizes))
    last = len(sizes) - 1  # of the classes, the one of the other texts; of the columns, the one without a class follows
    which = F.coalesce(*[F.when(F.col("lang") == name, k) for k, (name, _) in enumerate(named)], F.lit(last))
    marked = texts.select(F.when(train, which).otherwise(last + 1).alias("class"), "text")
    words = store.put("words", _count_words(marked, last + 1))
    store.settle()
    columns = _counts(last + 1)
    sums = words.agg(
        *[F.sum(n) for n in columns], *[F.count_if(F.col(n) > 0) for n in columns],
        F.count_if(F.greatest(F.lit(0), *columns) > 0), F.sum("other"),
    ).first()
    totals = [
        Totals((sums[k] or 0) + n, (sums[last + 1 + k] or 0) + int(n > 0), n) for k, n in enumerate(sizes)
    ]
    whole = Totals(sum(t.tokens for t in totals), (sums[2 * last + 2] or 0) + int(ends > 0), ends)
    pieces = _fit(words, Pieces.from_ranks(rank_file), totals, rounds)
    scored = store.put("scored", _score_words(words, pieces, totals, whole))
    often = F.col("uses") >= max(1.0, heavy * (whole.tokens - ends + (sums[2 * last + 3] or 0)))
    frequent = scored.filter(often).select("word", "known", "base", "scores").toArrow()
    numbered = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    heads = store.put("heads", _score_heavy(numbered, frequent, totals, whole))
    store.settle()
    scores = _scores(last + 1)
    rare = (
        heads.select("row", F.explode("rare").alias("rare")).select("row", "rare.word", "rare.n")
        .join(scored.filter(~often), "word").groupBy("row").agg(
            F.sum(F.col("n") * F.col("known")).alias("rare_known"), F.sum(F.col("n") * F.col("base")).alias("rare_base"),
            *[F.sum(F.col("n") * F.col("scores")[k]).alias(f"rare_{name}") for k, name in enumerate(scores)],
        )
    )

    def total(name: str) -> Column:
        return F.col(name) + F.coalesce(F.col(f"rare_{name.removeprefix('n_')}"), F.lit(0))

    top = F.greatest(*scores, F.lit(float("-inf")))
    both = heads.drop("rare").join(rare, "row", "left").withColumns({name: total(name) for name in scores})
    summed = top + F.log10(sum((F.pow(F.lit(10.0), F.col(name) - top) for name in scores), F.lit(0.0)))
    return both.select(
        "doc_id", "n_tokens", total("n_known").cast("long").alias("n_known"),
        F.lit(whole.tokens).cast("long").alias("train_tokens"), total("base").alias("base_score"), F.when(top > float("-inf"), summed).otherwise(top).alias("score"),
    )
