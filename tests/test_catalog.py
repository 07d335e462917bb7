"""Every registered query against its SQL counterpart, on the smallest test tables."""

from __future__ import annotations

import os
import sys

import pytest

import __spark_entry__ as entry
from outlay.catalog.oracle import all_oracles
from outlay.catalog.registry import all_queries

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "tools"))
from check_oracle import TABLES, rows  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    db = duckdb.connect()
    for table in TABLES.split():
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return db


def test_every_query_has_a_counterpart():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entry.queries()) and set(all_oracles()) <= set(entry.oracle_sql())


@needs_data
@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_its_counterpart(spark, database, name):
    df = all_queries()[name](spark, FOLDER)
    cursor = database.execute(all_oracles()[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(
        [d[0] for d in cursor.description], cursor.fetchall()
    )


@needs_data
def test_entry_is_stable(spark):
    first, second = entry.entry(spark), entry.entry(spark)
    assert first.schema == second.schema and first.count() == second.count() > 0
