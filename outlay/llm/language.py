"""Language identification by rank-order profiles.

A profile is the list of a text's most frequent letter n-grams (one to three letters, words padded
by a blank on either side), most frequent first, equal counts by code. Each language has one
profile, learned from the counts of all its labelled texts. A document gets the language with the
least out-of-place distance: over the n-grams of its own profile, the sum of the differences of
ranks, or the profile length where the language's profile lacks the n-gram. Equal distances go to
the first language in alphabetical order. The score is 1 minus the distance over the largest
possible one, so 0 means that no n-gram is known.

Null texts, empty texts and texts without a letter are ``und`` with score 0, and so is every text if
nothing could be learned. Null languages and null texts teach nothing. Texts are read whole; rows
are independent, so repeated rows get equal predictions. Other columns are left out of the result of
``predict`` unless named, and ``keep_identified`` keeps them all.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outlay.llm.tables import Tally, pick, slices

PROFILE = 300
SLICE = 1 << 18  # bytes of text whose n-grams are counted together
UNKNOWN = "und"
BITS = np.uint64(21)  # any code point; three of them fit into 63 bits


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams_of(text: str | None) -> np.ndarray:
    """The codes of all n-grams of the text's words, in lower case."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.concatenate([[0], np.where(_letters()[codes], codes, 0), [0]]).astype(np.uint64)
    one, two = codes[1:], codes[:-1] << BITS | codes[1:]
    inner = codes[1:-1] != 0
    three = (codes[:-2] << (BITS + BITS) | codes[1:-1] << BITS | codes[2:])[inner]
    return np.concatenate([one[one != 0], two[(codes[:-1] != 0) | (codes[1:] != 0)], three])


def ranked(grams: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent codes, most frequent first, equal counts by code."""
    unique, counts = np.unique(grams, return_counts=True)
    return unique[np.argsort(-counts, kind="stable")[:size]]


class Profiles:
    """The languages' profiles as one table: known n-grams by language, in ranks."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.size, self.languages = size, sorted(profiles)
        self.known = np.unique(np.array([g for p in profiles.values() for g in p], np.uint64))
        self.ranks = np.full((len(self.languages), len(self.known) + 1), -1, np.int64)  # the last column: unknown
        for row, language in enumerate(self.languages):
            grams = np.array(profiles[language], np.uint64)
            self.ranks[row, np.searchsorted(self.known, grams)] = np.arange(len(grams))

    def predict(self, text: str | None) -> tuple[str, float]:
        own = ranked(grams_of(text), self.size)
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.known, own), len(self.known) - 1)
        at = np.where(self.known[at] == own, at, len(self.known))
        ranks = self.ranks[:, at]
        distance = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own)))).sum(axis=1)
        best = int(distance.argmin())
        score = 1.0 - float(distance[best]) / (self.size * len(own))
        return self.languages[best], max(score, 0.0)


def learn(labelled: DataFrame, size: int = PROFILE) -> Profiles:
    """Profiles from the columns ``text`` and ``lang``.

    Every text counts. Tasks sum n-gram counts by language before the shuffle, and the driver
    receives ``size`` rows for each language: the model itself.
    """
    source = pick(labelled, "lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL")

    def count(batches):
        tallies: dict[str, Tally] = {}
        for part in slices(batches, limit=SLICE):
            by_language: dict[str, list[np.ndarray]] = {}
            for language, text in zip(*(part.column(i).to_pylist() for i in (0, 1)), strict=True):
                by_language.setdefault(language, []).append(grams_of(text))
            for language, grams in by_language.items():
                unique, counts = np.unique(np.concatenate(grams), return_counts=True)
                tallies.setdefault(language, Tally()).add(unique, counts)
        for language, tally in tallies.items():
            grams, counts = tally.total()
            for start in range(0, len(grams), 50_000):
                part = slice(start, start + 50_000)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([language] * len(grams[part])),
                    "gram": grams[part].astype(np.int64), "n": counts[part],
                })

    counts = source.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("gram"))
    rows = (
        counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= size)
        .select("lang", "gram", "place").collect()
    )
    profiles: dict[str, list[int]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["place"])):
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return Profiles(profiles, size)


def predict(docs: DataFrame, profiles: Profiles, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of each row, ``lang_pred`` and ``score``; only the text decides."""
    source = pick(docs, *keep, "text").withColumnRenamed("text", "_text")
    schema = T.StructType([
        *source.schema.fields[:-1], T.StructField("lang_pred", T.StringType(), False),
        T.StructField("score", T.DoubleType(), False),
    ])
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches):
        model = shared.value
        for part in slices(batches, "_text"):
            found = [model.predict(text) for text in part.column(len(keep)).to_pylist()]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *columns], [*keep, "lang_pred", "score"])

    return source.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """The rows whose language is identified, with all their columns."""
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in slices([batch], batch.schema.names[at]):
                known = [model.predict(text)[0] != UNKNOWN for text in part.column(at).to_pylist()]
                yield part.filter(pa.array(known, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column, folds: int) -> Column:
    """Whether crc32 of the id as text leaves 2 on division by ``folds``; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 2, F.lit(False))
