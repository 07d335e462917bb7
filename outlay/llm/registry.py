"""The operators as named queries over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outlay.llm import (
    alignment, bpe, collocations, decontamination, euclid, html, jaccard, language, lattice, lines, secrets, sharding, substrings,
)
from outlay.llm.oracles import ORACLES

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
SHARDS = 16
LINE_DOCS = 10
ALIGNED_FILES = ("byte_bpe_50k.json", "piece_bpe_32k.model")
PHRASE_COUNT, PHRASE_WORDS, PHRASES = 100, 5, 2000


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rank_file() -> bytes:
    """The rank file's content: it lies with the installed tokenizers on the driver, and tasks get it by broadcast."""
    with open(public_tokenizers.path(RANK_FILE), "rb") as file:
        return file.read()


def op1_subword_lattice(spark: SparkSession, folder: str) -> DataFrame:
    out = language.held_out(F.col("doc_id"), 7)
    scored = lattice.score_texts(_table(spark, folder, "documents"), ~out, rank_file())
    return scored.withColumn("held_out", out)


def op2_external_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.digests(_table(spark, folder, "documents"), SHARDS)


def op3_spaced_seed_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_overlaps(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op4_rank_order_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    out = language.held_out(F.col("doc_id"), 4)
    profiles = language.learn(docs.filter(~out))
    return language.predict(docs, profiles).withColumn("held_out", out).select("doc_id", "held_out", "lang_pred", "score")


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(_table(spark, folder, "documents"), rank_file(), public_tokenizers.PATTERN)


def op6_best_subsequence_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.digests(_table(spark, folder, "pages"))


def op7_linked_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digests(_table(spark, folder, "documents"))


def op8_lsh_forest_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, folder, "documents")).drop("row")


def op9_p_stable_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return euclid.near_duplicates(_table(spark, folder, "embeddings"))


def op10_suffix_tree_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.digests(_table(spark, folder, "documents"))


def op11_line_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    return lines.digests(_table(spark, folder, "documents"), LINE_DOCS)


def alignment_files() -> tuple[bytes, bytes, str]:
    """The two vocabularies that are aligned, byte-level BPE and pieces, and the pattern of the first."""
    found = []
    for name in ALIGNED_FILES:
        with open(public_tokenizers.path(name), "rb") as file:
            found.append(file.read())
    return found[0], found[1], public_tokenizers.PATTERN


def op12_identity_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(_table(spark, folder, "documents"), *alignment_files()).documents


def op13_tiled_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"), PHRASE_COUNT, PHRASE_WORDS, PHRASES)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_subword_lattice, op2_external_shuffle, op3_spaced_seed_decontamination, op4_rank_order_language, op5_byte_bpe,
        op6_best_subsequence_text, op7_linked_secrets, op8_lsh_forest_join, op9_p_stable_near_duplicates, op10_suffix_tree_dedup,
        op11_line_bitmaps, op12_identity_alignment, op13_tiled_collocations,
    )
    return {query.__name__: query for query in found}


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
