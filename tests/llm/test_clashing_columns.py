"""Extra columns, whatever their names, change nothing, and columns are found in any case."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from outlay.llm import (
    alignment, bpe, collocations, decontamination, euclid, html, jaccard, language, lattice, lines, registry, secrets, sharding, substrings,
)

ROWS = [(1, "some text of a few words that is here twice"), (2, "some text of a few words that is here twice"),
        (3, "token=abcdefghijklmnop and more"), (4, None), (None, "no id")]
ITEM = "some text of a few words that is here twice"

OPERATORS = {
    "bpe": lambda d, b: bpe.digests(d, registry.rank_file(), public_tokenizers.PATTERN),
    "secrets": lambda d, b: secrets.digests(d),
    "language": lambda d, b: language.predict(d, language.learn(d)),
    "decontamination": decontamination.find_overlaps,
    "jaccard": lambda d, b: jaccard.near_duplicates(d).drop("row"),
    "substrings": lambda d, b: substrings.digests(d),
    "lattice": lambda d, b: lattice.score_texts(d, F.col("doc_id") > 1, registry.rank_file()).withColumn("score", F.round("score", 6)).withColumn("base_score", F.round("base_score", 6)),
    "lines": lambda d, b: lines.digests(d, 2),
    "alignment": lambda d, b: alignment.align(d, *registry.alignment_files()).documents,
    "collocations": lambda d, b: collocations.collocations(d, 2),
    "sharding": lambda d, b: sharding.external_shuffle(d, 3).groupBy("shard").count().select("count"),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_extra_columns(name, documents, clashing, stored):
    bench = stored([(1, ITEM, 5)], "item_id long, text string, doc_id long")
    plain, extra = (OPERATORS[name](d(*ROWS), bench).collect() for d in (documents, clashing))
    assert sorted(map(repr, plain)) == sorted(map(repr, extra)) and plain


def test_extra_columns_of_pages_and_vectors(stored):
    pages = [(1, "u", "<article><p>some text</p></article>"), (None, "v", None)]
    plain = html.digests(stored(pages, "page_id long, url string, html string"))
    extra = html.digests(stored([("t", 5, *r, "x") for r in pages], "text string, n_chars int, page_id long, url string, html string, Html_ string"))
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, extra.collect())) and plain.count() == 2
    vectors = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (None, None)]
    plain = euclid.near_duplicates(stored(vectors, "vec_id long, embedding array<float>"))
    extra = euclid.near_duplicates(stored([("n", "v", *r, 1) for r in vectors], "node string, vector string, vec_id long, embedding array<float>, row int"))
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, extra.collect())) and plain.count() == 3


def test_columns_in_another_case(stored):
    docs = stored([(1, "some text", "x")], "DOC_ID long, Text string, extra string")
    assert secrets.digests(docs).columns[0] == "doc_id" and secrets.digests(docs).count() == 1
    with pytest.raises(ValueError, match="no column text"):
        secrets.digests(docs.drop("Text"))
