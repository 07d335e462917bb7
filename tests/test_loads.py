"""Versions, commits and lasting keys of the contract tables."""

from __future__ import annotations

import threading
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from outlay.operators import dimensions
from outlay.sources import commits, contracts
from outlay.sources.commits import CommitLog, Conflict, publish
from outlay.sources.key_book import KeyBook
from outlay.sources.writers import write_table

FACT = "invoice_id string, vendor_id int, employee_id int, dept_id int, trx_date date, amount decimal(10,2), budget_month_key string, vendor_key bigint, expense_id bigint"


def fact_rows(*rows):
    """(invoice, vendor, month, amount)"""
    return [(i, v, 1, 1, date.fromisoformat(f"{m}-10") if m else None, Decimal(str(a)), m, 900 + v, n) for n, (i, v, m, a) in enumerate(rows)]


def write_version(spark, folder, *rows, partitioned=True):
    count = write_table(
        spark.createDataFrame(fact_rows(*rows), FACT), f"{folder}/fact_expense", partition_by="budget_month_key" if partitioned else None)
    publish(spark, folder, "fact_expense", count)


def loaded(spark, target, table="fact_expense"):
    return contracts.read_loaded(spark, str(target), table)


A, B, C, N = ("a", 1, "2024-01", 5), ("b", 2, "2024-02", 6), ("c", 3, "2024-03", 7), ("n", 4, None, 8)


def test_a_rebuilt_table_replaces_what_it_was(spark, tmp_path):
    gold, target = str(tmp_path / "gold"), str(tmp_path / "w")
    write_version(spark, gold, A, B, N)
    assert contracts.load_table(spark, gold, target, "fact_expense") == 3
    first = CommitLog(spark, f"{target}/_commits/fact_expense").latest()
    assert contracts.load_table(spark, gold, target, "fact_expense") == 0
    write_version(spark, gold, N, B, A)  # new files, new order, the same rows
    assert contracts.load_table(spark, gold, target, "fact_expense") == 0
    assert loaded(spark, target).count() == 3
    second = CommitLog(spark, f"{target}/_commits/fact_expense").latest()
    assert second[0] == first[0] + 1
    assert [s["parts"] for s in second[1]["sources"].values()] == [s["parts"] for s in first[1]["sources"].values()]


@pytest.mark.parametrize("partitioned", [True, False])
def test_only_months_that_differ_are_written(spark, tmp_path, partitioned):
    gold, target = str(tmp_path / "gold"), str(tmp_path / "w")
    write_version(spark, gold, A, B, N, partitioned=partitioned)
    contracts.load_table(spark, gold, target, "fact_expense")
    ids = {r.invoice_id: r.expense_id for r in loaded(spark, target).collect()}
    more = ("b2", 2, "2024-02", 9)
    write_version(spark, gold, A, B, more, C, partitioned=partitioned)  # February grows, March is new, the rows without a month go
    assert contracts.load_table(spark, gold, target, "fact_expense") == 3
    rows = {r.invoice_id: (r.budget_month_key, r.expense_id) for r in loaded(spark, target).collect()}
    assert {i: m for i, (m, _) in rows.items()} == {"a": "2024-01", "b": "2024-02", "b2": "2024-02", "c": "2024-03"}
    assert rows["a"][1] == ids["a"] and rows["b"][1] > max(ids.values())
    assert len({n for _, n in rows.values()}) == 4
    assert contracts.remove_unnamed(spark, target, "fact_expense") == 0  # January still lies in the first folder
    write_version(spark, gold, C, partitioned=partitioned)
    assert contracts.load_table(spark, gold, target, "fact_expense") == 0
    assert contracts.remove_unnamed(spark, target, "fact_expense") == 1
    assert [r.invoice_id for r in loaded(spark, target).collect()] == ["c"]


def test_sources_do_not_replace_each_other(spark, tmp_path):
    target = str(tmp_path / "w")
    for name, row in (("one", A), ("two", B), ("two", C)):
        write_version(spark, f"{tmp_path}/{name}", row)
        contracts.load_table(spark, f"{tmp_path}/{name}", target, "fact_expense")
    rows = loaded(spark, target).collect()
    assert sorted(r.invoice_id for r in rows) == ["a", "c"] and len({r.expense_id for r in rows}) == 2


def test_loads_at_once_take_turns(spark, tmp_path):
    target, errors = str(tmp_path / "w"), []
    sources = [f"{tmp_path}/s{i}" for i in range(3)]
    for i, source in enumerate(sources):
        write_version(spark, source, *[(f"{i}-{j}", j, "2024-01", 1 + j) for j in range(20)])

    def load(source):
        try:
            contracts.load_table(spark, source, target, "fact_expense")
        except Exception as error:  # a thread's error is the test's
            errors.append(error)

    threads = [threading.Thread(target=load, args=(s,)) for s in (*sources, *sources)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    rows = loaded(spark, target).collect()
    assert not errors and len(rows) == 60 == len({r.invoice_id for r in rows}) == len({r.expense_id for r in rows})
    assert CommitLog(spark, f"{target}/_commits/fact_expense").latest()[0] == 3


def test_a_beaten_load_starts_again(spark, tmp_path, monkeypatch):
    """Another load commits between this one's reading and its commit."""
    target, turns = str(tmp_path / "w"), []
    write_version(spark, f"{tmp_path}/one", A, B)
    write_version(spark, f"{tmp_path}/two", C)
    commit = CommitLog.commit

    def late(self, number, state):
        if not turns and self.files.folder.endswith("_commits/fact_expense"):
            turns.append(number)
            assert contracts.load_table(spark, f"{tmp_path}/two", target, "fact_expense") == 1
        commit(self, number, state)

    monkeypatch.setattr(CommitLog, "commit", late)
    assert contracts.load_table(spark, f"{tmp_path}/one", target, "fact_expense") == 2
    rows = loaded(spark, target).collect()
    assert sorted(r.invoice_id for r in rows) == ["a", "b", "c"] and len({r.expense_id for r in rows}) == 3
    assert contracts.remove_unnamed(spark, target, "fact_expense") == 0  # the beaten attempt cleaned up


def test_new_files_are_brought_in_a_few_at_a_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(contracts, "FILES_AT_ONCE", 2)
    rows = spark.range(50).selectExpr("cast(id as int) AS dept_id", "concat('D', id) AS dept_name", "'2024-01' AS budget_month",
                                      "cast(5 as decimal(12,2)) AS budget_amount", "'USD' AS currency")
    rows.repartition(5).write.parquet(f"{tmp_path}/gold/fact_budget")
    assert contracts.load_table(spark, f"{tmp_path}/gold", f"{tmp_path}/w", "fact_budget") == 50
    assert contracts.load_table(spark, f"{tmp_path}/gold", f"{tmp_path}/w", "fact_budget") == 0
    rows.repartition(3).write.mode("append").parquet(f"{tmp_path}/gold/fact_budget")
    assert contracts.load_table(spark, f"{tmp_path}/gold", f"{tmp_path}/w", "fact_budget") == 50
    found = loaded(spark, f"{tmp_path}/w", "fact_budget")
    assert found.count() == 100 == found.select("budget_id").distinct().count()
    assert loaded(spark, f"{tmp_path}/none", "fact_budget").count() == 0


def vendors(spark, *rows):
    return spark.createDataFrame([(i, n, "Technology", "US") for i, n in rows], "vendor_id int, vendor_name string, category string, country string")


def test_dimensions_merge_by_id(spark, tmp_path):
    gold, target = str(tmp_path / "gold"), str(tmp_path / "w")

    def load(*rows):
        publish(spark, gold, "dim_vendor", write_table(vendors(spark, *rows), f"{gold}/dim_vendor"))
        contracts.load_table(spark, gold, target, "dim_vendor")
        return {r.vendor_id: r for r in loaded(spark, target, "dim_vendor").collect()}

    first = load((5, "five"), (9, "nine"), (7, "seven"))
    assert {i: r.vendor_key for i, r in first.items()} == {5: 1, 7: 2, 9: 3}
    second = load((1, "one"), (5, "five"), (9, "NINE"))  # a small id, one renamed, one gone
    assert {i: r.vendor_key for i, r in second.items()} == {5: 1, 7: 2, 9: 3, 1: 4}
    assert second[9].vendor_name == "NINE" and second[7].vendor_name == "seven"
    assert {i: second[i].created_timestamp == first[i].created_timestamp for i in first} == {5: True, 7: True, 9: True}
    assert {i: second[i].updated_timestamp == first[i].updated_timestamp for i in first} == {5: True, 7: True, 9: False}
    assert loaded(spark, target, "dim_vendor").count() == 4
    third = load((1, "one"), (3, "three"))
    assert third[3].vendor_key == 5 and len(third) == 5


def test_facts_take_the_keys_of_the_store(spark, tmp_path):
    gold, target = str(tmp_path / "gold"), str(tmp_path / "w")
    write_version(spark, gold, A, C)
    contracts.load_table(spark, gold, target, "fact_expense")
    assert {r.vendor_id: r.vendor_key for r in loaded(spark, target).collect()} == {1: 901, 3: 903}  # there are no vendors yet
    publish(spark, gold, "dim_vendor", write_table(vendors(spark, (3, "c"), (2, "b")), f"{gold}/dim_vendor"))
    contracts.load_table(spark, gold, target, "dim_vendor")
    write_version(spark, gold, A, ("c", 3, "2024-03", 70))
    contracts.load_table(spark, gold, target, "fact_expense")
    assert {r.vendor_id: r.vendor_key for r in loaded(spark, target).collect()} == {1: 901, 3: 2}  # January did not change


def test_keys_last(spark, tmp_path, monkeypatch):
    from outlay.sources import key_book

    monkeypatch.setattr(key_book, "MOST_FOLDERS", 2)

    def dimension(*ids):
        book = KeyBook(spark, str(tmp_path / "keys"), "vendor_id", "vendor_key")
        expenses = spark.createDataFrame([(i, f"V{i}") for i in ids for _ in range(2)], "vendor_id int, vendor_name string")
        return {r.vendor_id: r.vendor_key for r in dimensions.dim_vendor(expenses, number=book.numbered).collect()}

    assert dimension(50, 40, None) == {None: 1, 40: 2, 50: 3}
    assert dimension(50, 10, 60) == {10: 4, 50: 3, 60: 5}
    assert dimension(-5, 40) == {-5: 6, 40: 2}
    assert dimension(20, None) == {20: 7, None: 1}  # the folders have been merged by now
    assert dimension(10, 20, 60, -5) == {10: 4, 20: 7, 60: 5, -5: 6}
    book = KeyBook(spark, str(tmp_path / "keys"), "vendor_id", "vendor_key")
    assert book.read().select("vendor_key").distinct().count() == 7 == book.read().count()
    with pytest.raises(ValueError):
        book.numbered(spark.range(1), "id", "vendor_key")
    empty = KeyBook(spark, str(tmp_path / "other"), "id", "key")
    assert empty.read() is None and empty.assign(spark.range(0)).count() == 0


def test_keys_that_are_given_at_once_are_different(spark, tmp_path):
    found, errors = [], []

    def assign(low):
        try:
            book = KeyBook(spark, str(tmp_path / "keys"), "id", "key")
            found.append({r.id: r.key for r in book.assign(spark.range(low, low + 30)).collect()})
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=assign, args=(low,)) for low in (0, 20, 40)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    final = {r.id: r.key for r in KeyBook(spark, str(tmp_path / "keys"), "id", "key").read().collect()}
    assert not errors and len(final) == 70 == len(set(final.values()))
    assert all(final[i] == k for part in found for i, k in part.items())


def test_a_number_is_taken_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.latest() == (0, {})
    log.commit(1, {"x": 1})
    with pytest.raises(Conflict):
        log.commit(1, {"x": 2})
    assert log.latest() == (1, {"x": 1}) and log.files.names() == ["00000000000000000001.json"]
    assert commits.published_version(spark, str(tmp_path), "t") == 0
    assert [publish(spark, str(tmp_path), "t", 5), publish(spark, str(tmp_path), "t", 6)] == [1, 2]


def test_a_source_gathered_by_month_is_loaded_without_an_exchange(spark, tmp_path, monkeypatch):
    """Its rows are read month by month; only many small files, or none by month, are gathered anew."""
    seen = []

    def watched(df, path, partition_by=None, gathered=False, **more):
        if partition_by:
            seen.append(gathered)
        return write_table(df, path, partition_by=partition_by, gathered=gathered, **more)

    monkeypatch.setattr(contracts, "write_table", watched)
    rows = [(f"i{i}", i % 3, f"2024-0{i % 4 + 1}", i + 1) for i in range(40)] + [N]
    write_version(spark, str(tmp_path / "few"), *rows)
    write_version(spark, str(tmp_path / "plain"), *rows, partitioned=False)
    scattered = spark.createDataFrame(fact_rows(*rows), FACT).repartition(20)
    scattered.write.partitionBy("budget_month_key").parquet(str(tmp_path / "many" / "fact_expense"))
    publish(spark, str(tmp_path / "many"), "fact_expense", len(rows))
    tables = []
    for source in ("few", "plain", "many"):
        assert contracts.load_table(spark, str(tmp_path / source), str(tmp_path / f"w_{source}"), "fact_expense") == len(rows)
        table = loaded(spark, tmp_path / f"w_{source}")
        assert table.select("expense_id").distinct().count() == len(rows)
        tables.append(sorted((r.invoice_id, r.amount, r.budget_month_key or "") for r in table.collect()))
    assert seen == [True, False, False] and tables[0] == tables[1] == tables[2]
    files = spark.read.parquet(*[f"{tmp_path}/w_few/fact_expense"]).inputFiles()
    assert len(files) <= 10
