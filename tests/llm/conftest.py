from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def stored(spark, tmp_path_factory):
    """Write rows as a Parquet table and read it back, as the operators' inputs are."""

    def build(rows, schema, files=2):
        path = str(tmp_path_factory.mktemp("table") / "data.parquet")
        spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    return build


@pytest.fixture(scope="session")
def documents(stored):
    """Documents from (doc_id, text) or (doc_id, text, lang)."""

    def build(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or "")) for r in rows]
        return stored(full, DOCS)

    return build


@pytest.fixture(scope="session")
def clashing(stored):
    """The same documents with columns whose names the operators use or that differ in case alone."""

    def build(*rows):
        schema = "row long, doc_id long, text string, TEXT_ string, class string, score string, shard string, slot string, key string, part string, lang string"
        return stored([(9, r[0], r[1], "x", "c", "s", "h", "l", "k", "p", "en") for r in rows], schema)

    return build
