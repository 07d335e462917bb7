"""From raw documents to token digests: five stages over the operators of ``outlay.llm``.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns a DataFrame that is written as
Parquet and read again as the next one's documents. All but the last return the columns of ``documents``.
Null and empty texts, which have no language, go in the first stage; no stage fails on them. Ids may be null or repeat.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outlay.llm import bpe, decontamination, jaccard, language, secrets
from outlay.llm.registry import rank_file
from outlay.llm.tables import Store


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents in which no language can be identified; profiles come from all labelled documents."""
    return language.keep_identified(docs, language.learn(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each class of near-duplicates."""
    return jaccard.keep_first_of_class(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that overlap with a benchmark item."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by the name of its kind; ``n_chars`` follows the text."""
    return secrets.redact_secrets(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The digests of each document's token ids and of the bytes they decode to."""
    return bpe.digests(docs, rank_file(), public_tokenizers.PATTERN, ("doc_id", "lang", "source"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("secret_scan", redact_secrets),
    ("byte_bpe", encode),
]
# Rank-order profiles, hash forests and merges by rank are beyond SQL; the tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    store = Store(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = store.put(name, stage(spark, docs, sf_dir))
    return last(spark, docs, sf_dir)
