"""Plans that keep a hot key from landing in one task."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rows import expense
from outlay import schemas
from outlay.catalog.inputs import Tables
from outlay.functions import repeat_rows, small_side
from outlay.operators import cleaning, dimensions, facts, kpis, rules, views
from outlay.params import Thresholds
from outlay.plans import stages
from outlay.sources.readers import tasks_of_rows
from outlay.sources.steps import read_steps, write_steps
from outlay.sources.writers import write_table


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    before = {}

    def change(**values):
        for name, value in values.items():
            name = name.replace("__", ".")
            before[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_a_hot_vendor_is_split_when_dimensions_are_large(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
        spark__sql__shuffle__partitions="16",
    )
    rows = spark.range(30_000, numPartitions=16).select(
        F.concat(F.lit("I"), "id").alias("invoice_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500).cast("int").alias("vendor_id"),
        (F.col("id") % 50).cast("int").alias("employee_id"), (F.col("id") % 5).cast("int").alias("dept_id"),
        F.lit("2024-01-01").cast("date").alias("trx_date"), F.lit(1).cast("decimal(10,2)").alias("amount"),
        F.lit("USD").alias("currency"), F.lit("Wire").alias("payment_method"),
    )

    def keyed(column, key, size):
        return spark.range(size).select(F.col("id").cast("int").alias(column), F.col("id").alias(key))

    calendar = spark.createDataFrame([(date(2024, 1, 1), "2024-01", 1)], "date date, month_key string, calendar_key bigint")
    fact = facts.fact_expense(
        rows, keyed("vendor_id", "vendor_key", 500), keyed("employee_id", "employee_key", 50),
        keyed("dept_id", "dept_key", 5), F.broadcast(calendar),
    )
    assert "SortMergeJoin(skew=true)" in final_plan(fact)
    assert fact.filter("vendor_key IS NULL OR dept_key IS NULL").count() == 0 and fact.count() == 30_000


def test_a_hot_vendor_day_is_expanded_by_many_tasks(spark):
    counts = spark.createDataFrame([("hot", 400_000), ("cold", 3)], "k string, n bigint")
    tasks = repeat_rows(counts, "n", "k").groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in tasks) == 400_003
    assert max(r["count"] for r in tasks) < 300_000


def test_rules_window_days_and_not_expenses(spark, fact, names):
    df = fact(("A", 1, 1, 1, "2024-01-01", 1))
    plan = rules.duplicate_invoices(df, names("vendor_id", "vendor_name", 1))._jdf.queryExecution().optimizedPlan().toString()
    window = plan.index("Window [")
    assert "Aggregate [vendor_id" in plan[window:]


def test_no_plan_sorts_all_rows_in_one_task(spark):
    signals = spark.createDataFrame(
        [(i, "a", "vendor", "1", "N", date(2024, 1, 1) + timedelta(i % 3), 80.0, "x") for i in range(50)],
        "signal_id bigint, rule_name string, entity_type string, entity_id string, entity_name string, "
        "signal_date date, score double, details string",
    )
    flags = views.leakage_flags(signals, F.lit("2024-01-02").cast("date"))
    plan = flags._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(score" in plan and "Window" not in plan and "SinglePartition" not in plan


def test_a_partitioned_write_splits_a_hot_month(spark, settings, tmp_path):
    settings(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
        spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
    )
    df = spark.range(40_000, numPartitions=8).select(
        F.when(F.col("id") % 2 == 0, "2024-01").otherwise(F.concat(F.lit("2023-"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0"))).alias("m"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    path = tmp_path / "t"
    assert write_table(df, str(path), partition_by="m", row_id="row") == 40_000
    assert len(list((path / "m=2024-01").glob("*.parquet"))) > 2
    assert spark.read.parquet(str(path)).select("row").distinct().count() == 40_000


def scans(df):
    """The reads of files in the plan that ran, subqueries included; initial plans are passed over."""
    df.collect()
    found, skipped = 0, None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skipped is not None and depth < skipped:
            skipped = None
        if "== Initial Plan ==" in line and skipped is None:
            skipped = depth
        found += skipped is None and "FileScan parquet" in line
    return found


def test_shared_reads_of_the_fact(spark, fact, names, tmp_path):
    path = str(tmp_path / "fact")
    fact(*[(f"I{i}", i % 5, 1, 1, "2024-01-0" + str(i % 9 + 1), 10 + i) for i in range(60)]).write.parquet(path)
    stored = spark.read.parquet(path)
    vendors = names("vendor_id", "vendor_name", 0, 1, 2)
    assert scans(rules.near_duplicate_invoices(stored, vendors)) == 1
    shares = kpis.vendor_concentration(stored, vendors)
    assert scans(shares) == 1


def test_dimensions_read_the_facts_once_and_hash_them(spark, expenses, tmp_path):
    path, members = str(tmp_path / "expenses"), str(tmp_path / "members")
    expenses(*[expense(f"I{i}", i % 7, i % 3, 1, "2024-01-01", 5) for i in range(50)]).write.parquet(path)
    plans = []

    def settle(rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        rows.write.parquet(members)
        return spark.read.parquet(members)

    keyed = dimensions.dim_vendor(spark.read.parquet(path), settle)
    assert plans[0].count("FileScan parquet") == 1
    assert "HashAggregate" in plans[0][plans[0].index("FileScan") - 400 : plans[0].index("FileScan")]
    assert keyed.count() == 7 and path not in "".join(keyed.inputFiles())


def test_a_size_check_sends_no_rows_to_one_task(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert "ResolvedHint" in small_side(table, 1000)._jdf.queryExecution().analyzed().toString()
    counted = table.groupBy().count()._jdf.queryExecution().executedPlan().toString()
    assert "LocalLimit" not in counted and "partial_count" in counted


def steps_input(spark, rows=3000):
    """Entity 1 (or none) holds two thirds of the rows, most of them on one day; ids are unique."""
    return spark.range(rows).select(
        F.when(F.col("id") % 3 < 2, 1).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 40).cast("int").alias("e"),
        F.date_add(F.lit("2024-01-01"), F.when(F.col("id") % 5 < 4, 0).otherwise(F.col("id") % 9).cast("int")).alias("d"),
        F.concat(F.lit("S-"), F.lpad(F.hash("id").cast("string"), 12, "0")).alias("s"),
        F.when(F.col("id") % 4 > 0, F.col("id") * 1.25).cast("decimal(10,2)").alias("v"), (F.col("id") % 11).cast("int").alias("w"),
    )


@pytest.mark.parametrize("ranges", ["1", "7", "64"])
def test_steps_equal_a_plain_window_whatever_the_ranges(spark, settings, tmp_path, ranges):
    settings(
        spark__sql__shuffle__partitions=ranges, spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__execution__arrow__maxRecordsPerBatch="50",
    )
    df, path = steps_input(spark), str(tmp_path / "steps")
    assert write_steps(df, "e", ("d", "s"), ["v", "w"], path) == 3000
    assert (spark.read.parquet(f"{path}/ends").count() > 1) == (ranges != "1")
    order = Window.partitionBy("e").orderBy("d", "s")
    want = df.withColumns({"prev_v": F.lag("v").over(order), "prev_w": F.lag("w").over(order)})
    got = read_steps(spark, path, "e", ["v", "w"])
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_steps_of_no_rows_and_of_one(spark, tmp_path):
    for n in (0, 1):
        path = str(tmp_path / f"steps{n}")
        assert write_steps(steps_input(spark, n), "e", ("d", "s"), ["v", "w"], path) == n
        assert [(r.prev_v, r.prev_w) for r in read_steps(spark, path, "e", ["v", "w"]).collect()] == [(None, None)] * n


def test_steps_are_read_by_one_scan_and_no_exchange(spark, tmp_path):
    path = str(tmp_path / "steps")
    write_steps(steps_input(spark), "e", ("d", "s"), ["v", "w"], path)
    plan = read_steps(spark, path, "e", ["v", "w"])._jdf.queryExecution().sparkPlan().toString()
    assert plan.count(f"{path}/rows") <= 1 and plan.count("FileScan") == 2 and "SortMergeJoin" not in plan
    assert plan.count("Window") == 1 and plan.index("Window") > plan.index("BroadcastHashJoin")


def test_customers_join_the_orders_and_not_the_lines(spark):
    """Every table of customers has outgrown a broadcast at some size; the lines, the widest rows, must not be exchanged for them."""
    plan = Tables.shared(spark, "/root/testdata/sf0.001").raw_expenses._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    customers = next(i for i, line in enumerate(plan) if "Join" in line and "c_custkey" in line)
    below = []
    for i in range(customers + 1, len(plan)):
        if depth[i] <= depth[customers]:
            break
        below.append(plan[i])
    assert any("o_custkey" in line for line in below) and not any("l_orderkey" in line for line in below)


def test_counted_signals_are_expanded_after_the_sort(spark, fact, names, tmp_path):
    """The same rows as those of the plain rules, but what is exchanged for the order of the table are the counted ones, in chunks."""
    df = fact(*[(f"I{i}", i % 2, 1, 1, "2024-01-06" if i < 900 else f"2024-01-{i % 20 + 1:02d}", 10) for i in range(1000)])
    vendors, employees = names("vendor_id", "vendor_name", 0, 1), names("employee_id", "employee_name", 1)
    calendar = spark.createDataFrame([(date(2024, 1, d), d % 7 in (6, 0), d == 6) for d in range(1, 21)], "date date, is_weekend boolean, is_holiday boolean")
    many = Thresholds(sub_threshold_amount=100)

    def signals(counted):
        return rules.leakage_signals(
            rules.duplicate_invoices(df, vendors, many, counted), rules.sub_threshold_repeats(df, employees, many, counted),
            rules.weekend_holiday_claims(df, calendar, employees, counted), rules.round_number_spikes(df, names("dept_id", "dept_name", 1)),
        ).drop("created_timestamp")

    order = ("signal_date", "entity_id", "rule_name")
    assert signals(True).count() < 80
    rows = write_table(signals(True), str(tmp_path / "t"), row_id="signal_id", cluster_by=order, copies=rules.COPIES)
    written = spark.read.parquet(str(tmp_path / "t"))
    plain = signals(False)
    assert rows == plain.count() > 2500 and written.select("signal_id").distinct().count() == rows
    assert plain.exceptAll(written.drop("signal_id")).count() == 0 == written.select(plain.columns).exceptAll(plain).count()


def test_a_hot_day_of_counted_rows_is_written_by_many_tasks(spark, settings, tmp_path):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    counts = spark.createDataFrame([("hot", 100_000), ("cold", 3), ("none", 0)], "k string, n bigint")
    assert write_table(counts, str(tmp_path / "t"), cluster_by=("k",), copies="n") == 100_003
    files = spark.read.parquet(str(tmp_path / "t")).groupBy(F.input_file_name(), "k").count().collect()
    assert sorted({r["k"] for r in files}) == ["cold", "hot"]
    assert max(r["count"] for r in files) < 60_000


@pytest.mark.parametrize("own", [None, "2", "500"])
def test_accepted_rows_are_sorted_so_many_at_once(spark, settings, tmp_path, monkeypatch, own):
    """Parquet packs the rows of several CSV splits into one by bytes; the tasks that combine them take a bounded number of rows all the same."""
    settings(
        spark__sql__files__openCostInBytes="0", spark__sql__files__maxPartitionBytes="100k", spark__sql__shuffle__partitions="4",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    if own:
        settings(spark__sql__files__minPartitionNum=own)
    monkeypatch.setattr(stages, "ROWS_PER_SORT", 1000)
    rows = [f"I{i // 2},1,Vendor,1,Employee,1,Dept,2024-01-05,{5 + i % 2}.00,USD,Wire,the same text in every row\n" for i in range(24_000)]
    (tmp_path / "raw").mkdir()
    for part in range(24):
        lines = [",".join(schemas.EXPENSES.names) + "\n", *rows[1000 * part:1000 * (part + 1)]]
        (tmp_path / "raw" / f"{part:02}.csv").write_text("".join(lines))
    sorted_at_once = []

    def clean(accepted, source_file):
        per_task = accepted.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        sorted_at_once.append(per_task)
        return cleaning.clean_expenses(accepted, source_file)

    total, aside = stages.clean_csv(
        spark, str(tmp_path / "raw"), str(tmp_path / "clean" / "t"), cleaning.EXPENSES, clean, "t", "raw")
    assert sorted_at_once[0] <= 2000
    assert total == 12_000 and {(r.status, r.row_count) for r in aside.collect()} == {("clean", 12_000), ("duplicate", 12_000)}
    assert {r.amount for r in spark.read.parquet(str(tmp_path / "clean" / "t")).select("amount").distinct().collect()} == {Decimal("5.00")}
    assert len(list((tmp_path / "clean" / "t").glob("*.parquet"))) >= 24
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) == own and spark.conf.get("spark.sql.shuffle.partitions") == "4"


SPLITS, EXCHANGES = "spark.sql.files.minPartitionNum", "spark.sql.shuffle.partitions"


@pytest.fixture
def untouched(spark, settings):
    """A session in which neither setting was ever named, as a plain one is."""
    settings(spark__sql__files__minPartitionNum="1", spark__sql__shuffle__partitions="1")
    for name in (SPLITS, EXCHANGES):
        spark.conf.unset(name)
    assert spark.conf.get(SPLITS, None) is None and spark.conf.get(EXCHANGES, None) is None
    return spark


def test_accepted_rows_are_combined_in_a_session_of_default_settings(untouched, tmp_path):
    lines = [",".join(schemas.EXPENSES.names), *[f"I{i // 2},1,V,1,E,1,D,2024-01-05,{5 + i % 2}.00,USD,Wire,x" for i in range(10)], "I9,1,V,1,E,1,D,2024-01-05,n/a,USD,Wire,x"]
    (tmp_path / "raw.csv").write_text("\n".join(lines) + "\n")
    total, aside = stages.clean_csv(
        untouched, str(tmp_path / "raw.csv"), str(tmp_path / "clean" / "t"), cleaning.EXPENSES, cleaning.clean_expenses, "t", "raw.csv")
    assert total == 5
    assert sorted((r.status, r.reason, r.row_count) for r in aside.collect()) == [
        ("clean", None, 5), ("duplicate", None, 5), ("rejected", "amount does not fit", 1)]
    assert untouched.conf.get(SPLITS, None) is None and untouched.conf.get(EXCHANGES, None) is None


def test_default_settings_count_as_least_tasks_and_are_put_back(untouched):
    default, cores = int(untouched.conf.get(EXCHANGES)), untouched.sparkContext.defaultParallelism
    for rows, splits, exchanges in ((0, cores, default), (100 * default, 10 * default, 10 * default)):
        with tasks_of_rows(untouched, rows, 10):
            assert (untouched.conf.get(SPLITS), untouched.conf.get(EXCHANGES)) == (str(splits), str(exchanges))
    with pytest.raises(ZeroDivisionError), tasks_of_rows(untouched, 1, 0):
        pass
    assert untouched.conf.get(SPLITS, None) is None and untouched.conf.get(EXCHANGES, None) is None
