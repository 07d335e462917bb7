from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from outlay.functions import (
    centred_day_counts, dense_key, first_match, guarded_pct, KeyRuns, keep_first, key_runs, key_side, numeric_or_null,
    previous_values, repeat_rows, small_side, with_key,
)
from outlay.functions.counting import CHUNK_ROWS
from outlay.operators import facts
from outlay.sources.ranked import read_ranked, write_ranked


def test_keep_first_takes_the_smallest_row_with_nulls_first(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), (None, 5, "p"), (None, None, "q"), ("b", 7, None)],
        "k string, n int, t string",
    )
    kept = {r.k: (r.n, r.t) for r in keep_first(df, ["k"]).collect()}
    assert kept == {"a": (1, "y"), None: (None, "q"), "b": (7, None)}
    assert {r.k: r.t for r in keep_first(df, ["k"], ["t"]).collect()} == {"a": "x", None: "p", "b": None}
    assert keep_first(df, ["k"]).columns == df.columns
    assert keep_first(df.select("k"), ["k"]).count() == 3


def test_keep_first_combines_before_the_shuffle(spark):
    plan = keep_first(spark.range(10).withColumn("v", F.lit("x")), ["id"])._jdf.queryExecution().toString()
    assert "partial_min" in plan


def test_dense_key_ranks_over_cells_of_ids(spark):
    ids = [None, -70_000, -1, 0, 5, 65_535, 65_536, 200_000, 2_147_483_647, -2_147_483_648]
    keyed = dense_key(spark.createDataFrame([(i,) for i in ids], "id int"), "id", "key")
    expected = {v: n for n, v in enumerate([None, *sorted(i for i in ids if i is not None)], 1)}
    assert {r.id: r.key for r in keyed.collect()} == expected


def test_dense_key_ranks_64_bit_ids(spark):
    ids = [None, -(2**63), -(2**40) - 1, -(2**40), -1, 0, 1, 65_536, 2**32 - 1, 2**32, 2**32 + 70_000, 2**48 + 5, 2**63 - 1]
    keyed = dense_key(spark.createDataFrame([(i,) for i in ids], "id bigint"), "id", "key")
    expected = {v: n for n, v in enumerate([None, *sorted(i for i in ids if i is not None)], 1)}
    assert {r.id: r.key for r in keyed.collect()} == expected


def test_dense_key_ranks_dates_and_rejects_text(spark):
    days = [date(2024, 1, 2), date(1960, 5, 1), date(2024, 1, 1)]
    keyed = dense_key(spark.createDataFrame([(d,) for d in days], "d date"), "d", "key")
    assert {r.d: r.key for r in keyed.collect()} == {d: n for n, d in enumerate(sorted(days), 1)}
    with pytest.raises(TypeError):
        dense_key(spark.createDataFrame([("a",)], "d string"), "d", "key")


@pytest.mark.parametrize("rows", [5000, 1, 0])
def test_ranks_count_on_over_ranges(spark, tmp_path, rows):
    df = spark.range(rows).select((F.col("id") % 7).alias("g"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert write_ranked(df, (("g", "desc"), ("id", "asc")), str(tmp_path / "t")) == rows
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ranked = read_ranked(spark, str(tmp_path / "t"), "rank")
    expected = sorted(((i % 7, i) for i in range(rows)), key=lambda r: (-r[0], r[1]))
    assert ranked.columns == ["g", "id", "rank"]
    assert [(r["rank"], r.g, r.id) for r in sorted(ranked.collect(), key=lambda r: r["rank"])] == [(n, *r) for n, r in enumerate(expected, 1)]
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Exchange rangepartitioning" not in plan


def test_runs_give_the_same_keys_as_a_join(spark):
    dice = random.Random(9)
    ids = sorted(dice.sample(range(-70_000, 140_000), 3000)) + [2**40, 2**40 + 1]
    late = [i + 1 for i in ids[:50] if i + 1 not in set(ids)]
    members = [(i, k) for k, i in enumerate(ids, 1)] + [(i, 5000 + k) for k, i in enumerate(late)] + [(None, 9999)]
    dimension = spark.createDataFrame(members, "vendor_id long, vendor_key long")
    rows = spark.createDataFrame([(i,) for i in [*ids, *late, 7, -1, None, 2**40 + 2]], "vendor_id long")
    runs = key_runs(dimension, "vendor_id", "vendor_key")
    assert runs.filter("_gaps > 0").count() == 0
    found = with_key(rows, KeyRuns(F.broadcast(runs.drop("_gaps"))), "vendor_id", "vendor_key")
    assert sorted(map(str, found.collect())) == sorted(map(str, with_key(rows, dimension, "vendor_id", "vendor_key").collect()))
    gap = spark.createDataFrame([(1, 1), (3, 3)], "id int, key long")
    assert [r._gaps for r in key_runs(gap, "id", "key").collect()] == [1]
    side = key_side(gap, 2, "id", "key", lambda runs: (runs, 1), max_bytes=1)
    assert side is gap
    assert key_side(gap, 2, "id", "key", lambda runs: (runs.filter("false"), 3), max_rows=2, max_bytes=1) is gap


def test_large_dimensions_do_not_exchange_the_fact(spark):
    """Three dimensions above every broadcast limit, of dense ids: a few runs each, and the expenses stay where they are."""
    dimensions = {n: spark.range(1, 200_001).selectExpr(f"cast(id as int) AS {n}_id", f"id AS {n}_key") for n in ("vendor", "employee", "dept")}
    sides = {}
    for n, dimension in dimensions.items():
        sides[n] = key_side(dimension, 200_000, f"{n}_id", f"{n}_key", lambda runs: (runs, runs.count()), max_rows=1000)
        assert isinstance(sides[n], KeyRuns) and sides[n].runs.count() == 4
    expenses = spark.range(50).selectExpr(
        "concat('I', id) AS invoice_id", "cast(id * 4001 as int) AS vendor_id", "cast(id as int) AS employee_id", "cast(-id as int) AS dept_id",
        "date'2024-01-05' AS trx_date", "cast(5 as decimal(10,2)) AS amount", "'USD' AS currency", "'Wire' AS payment_method")
    calendar = F.broadcast(spark.sql("SELECT date'2024-01-05' AS date, '2024-01' AS month_key, 5 AS calendar_key"))
    fact = facts.fact_expense(expenses, sides["vendor"], sides["employee"], sides["dept"], calendar)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 3 and "SortMergeJoin" not in plan and "hashpartitioning(vendor_id" not in plan
    assert {(r.vendor_id, r.vendor_key, r.employee_key, r.dept_key) for r in fact.collect()} == {
        (4001 * i, 4001 * i if 0 < 4001 * i <= 200_000 else None, i or None, None) for i in range(50)}


def test_repeat_rows_keeps_every_copy(spark):
    df = spark.createDataFrame(
        [("a", 1), ("b", 3 * CHUNK_ROWS + 5), ("c", 0), ("d", CHUNK_ROWS)], "k string, n bigint"
    )
    counts = {r.k: r["count"] for r in repeat_rows(df, "n", "k").groupBy("k").count().collect()}
    assert counts == {"a": 1, "b": 3 * CHUNK_ROWS + 5, "d": CHUNK_ROWS}


def test_day_counts_include_the_window_edges(spark):
    start = date(2024, 1, 1)
    rows = [(1, start), (1, start), (1, start + timedelta(30)), (1, start + timedelta(61)), (None, start)]
    df = spark.createDataFrame(rows, "e int, d date")
    got = {(r.e, r.d): (r.rows_on_day, r.n) for r in centred_day_counts(df, "e", "d", 30, "n").collect()}
    assert got == {
        (1, start): (2, 3), (1, start + timedelta(30)): (1, 3), (1, start + timedelta(61)): (1, 1),
        (None, start): (1, 1),
    }


def test_previous_values_equal_a_plain_window(spark):
    rng = random.Random(5)
    rows = [
        # Entity 1 holds a third of all rows, most of them on one day.
        (rng.choice([1, 1, 2, 3, None, 4]), date(2024, 1, 1) + timedelta(rng.choice([0, 0, 0, 1, 2, 9])),
         f"S-{i:04d}", rng.choice([None, rng.randint(1, 50)]))
        for i in range(900)
    ]
    df = spark.createDataFrame(rows, "e int, d date, s string, v int")
    got = {r.s: r.prev_v for r in previous_values(df, "e", "d", "s", ["v"]).collect()}
    order = Window.partitionBy("e").orderBy("d", "s")
    expected = {r.s: r.p for r in df.withColumn("p", F.lag("v").over(order)).collect()}
    assert got == expected
    for crowd in (300, 20, 1):
        cut = previous_values(df, "e", "d", "s", ["v"], crowd=crowd)
        assert {r.s: r.prev_v for r in cut.collect()} == expected and cut.count() == 900


def test_column_helpers(spark):
    df = spark.createDataFrame([(5, 10, "1.5"), (5, 0, "abc"), (5, None, None)], "a int, b int, t string")
    assert [r.p for r in df.select(guarded_pct(F.col("a"), F.col("b")).alias("p")).collect()] == [50.0, 0.0, 0.0]
    label = first_match((F.col("b") > 5, "high"), (F.col("b") >= 0, "low"), default="none")
    assert [r.x for r in df.select(label.alias("x")).collect()] == ["high", "low", "none"]
    assert [r.t for r in numeric_or_null(df, ["t"]).collect()] == [1.5, None, None]


def test_small_side_hints_only_up_to_the_limit(spark):
    table = spark.range(10)

    def hinted(df):
        joined = spark.range(3).join(df, "id")
        return "ResolvedHint" in joined._jdf.queryExecution().analyzed().toString()

    assert hinted(small_side(table, max_rows=10))
    assert not hinted(small_side(table, max_rows=9))
    assert hinted(small_side(table, 9, max_rows=9)) and not hinted(small_side(table, 10, max_rows=9))
    assert not hinted(small_side(table, 1, max_bytes=8))
