from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from outlay import schemas
from outlay.sources import contracts
from outlay.sources.calendar import calendar_between, calendar_days, day_span
from outlay.sources.readers import fallback_budgets, load_budgets, read_table, spread_if_few_splits
from outlay.sources.writers import write_json, write_table


def test_calendar_of_the_sample_year(spark):
    days = {r.date: r for r in calendar_between(spark, "2024-01-01", "2024-12-31", schemas.HOLIDAYS_2024).collect()}
    assert len(days) == 366
    assert sum(r.is_holiday for r in days.values()) == 10
    assert sum(r.is_weekend for r in days.values()) == 104
    assert tuple(days[date(2024, 1, 1)]) == (date(2024, 1, 1), 1, "2024-01", "Q1", 2024, False, True)
    assert tuple(days[date(2024, 12, 29)])[1:6] == (52, "2024-12", "Q4", 2024, True)
    assert days[date(2024, 12, 30)].week == 1
    assert days[date(2024, 6, 1)].is_weekend and days[date(2024, 6, 30)].quarter == "Q2"


def test_calendar_spans_follow_the_data(spark):
    seen = spark.createDataFrame([(date(2023, 12, 30),), (date(2024, 1, 2),), (None,)], "d date")
    days = calendar_days(day_span(seen, "d"), yearly_holidays=["01-01"]).collect()
    assert [(r.date.isoformat(), r.is_holiday) for r in days] == [
        ("2023-12-30", False), ("2023-12-31", False), ("2024-01-01", True), ("2024-01-02", False),
    ]
    assert calendar_days(day_span(seen.filter("d is null"), "d")).count() == 0


def test_partitioned_table_keeps_null_months_and_counts_rows(spark, tmp_path):
    df = spark.createDataFrame([("2024-01", 1), ("2024-02", 2), (None, 3)], "budget_month_key string, v int")
    path = str(tmp_path / "t")
    assert write_table(df, path, partition_by="budget_month_key", row_id="row") == 3
    back = read_table(spark, path)
    assert dict(back.dtypes)["budget_month_key"] == "string"
    assert {(r.budget_month_key, r.v) for r in back.collect()} == {("2024-01", 1), ("2024-02", 2), (None, 3)}
    assert back.select("row").distinct().count() == 3
    pruned = back.filter(F.col("budget_month_key") == "2024-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(budget_month_key" in pruned
    assert write_table(df.limit(1), path, partition_by="budget_month_key") == 1
    assert read_table(spark, path).count() == 1


def test_json_sink(spark, tmp_path):
    write_json(spark.createDataFrame([("a", 1.5)], "metric string, value double"), str(tmp_path / "j"))
    assert [tuple(r) for r in spark.read.json(str(tmp_path / "j")).collect()] == [("a", 1.5)]


def test_budgets_fall_back_when_the_table_is_missing(spark, tmp_path):
    rows = load_budgets(spark, str(tmp_path / "missing"))
    assert rows.count() == 7
    assert dict(rows.dtypes) == {
        "dept_id": "int", "dept_name": "string", "budget_month": "string", "budget_amount": "decimal(12,2)",
    }
    assert rows.filter("dept_id = 3").first().budget_amount == Decimal("100000.00")
    write_table(fallback_budgets(spark).limit(2), str(tmp_path / "b"))
    assert load_budgets(spark, str(tmp_path / "b")).count() == 2


def test_spread_touches_only_tables_of_few_splits(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread_if_few_splits(spark.range(10, numPartitions=1), "id").rdd.getNumPartitions() == cores
    assert spread_if_few_splits(spark.range(10, numPartitions=cores + 1), "id").rdd.getNumPartitions() == cores + 1


def test_conform_fills_casts_orders_and_drops(spark):
    df = spark.createDataFrame([(7, "V", "extra")], "vendor_id int, vendor_name string, other string")
    out = contracts.conform(df, "dim_vendor")
    assert out.columns == [f.name for f in contracts.CONTRACTS["dim_vendor"]]
    row = out.first()
    assert (row.vendor_id, row.vendor_name, row.category) == (7, "V", None)
    assert row.vendor_key > 0 and row.created_timestamp is not None
    assert dict(out.dtypes)["vendor_id"] == "bigint" and dict(out.dtypes)["created_timestamp"] == "timestamp_ntz"


@pytest.mark.parametrize("row", [(None, "V"), (1, "x" * 256)])
def test_conform_rejects_missing_keys_and_long_texts(spark, row):
    df = spark.createDataFrame([row], "vendor_id int, vendor_name string")
    with pytest.raises(PySparkException, match="dim_vendor.vendor_"):
        contracts.conform(df, "dim_vendor").collect()


def test_conform_rejects_totals_that_do_not_fit_unless_widened(spark):
    df = spark.createDataFrame([(1, Decimal("12345678901.00"), 2)], "dept_id int, total_expenses decimal(20,2), expense_count int")
    with pytest.raises(PySparkException):
        contracts.conform(df, "summary_dept_expenses").collect()
    wide = contracts.conform(df, "summary_dept_expenses", wide_money=True).first()
    assert wide.total_expenses == Decimal("12345678901.00")


def test_every_contract_conforms_an_empty_table(spark):
    for table, fields in contracts.CONTRACTS.items():
        out = contracts.conform(spark.range(0), table)
        assert out.columns == [f.name for f in fields] and out.count() == 0


def test_a_folder_is_loaded_once(spark, tmp_path):
    source, target = str(tmp_path / "gold"), str(tmp_path / "warehouse")
    write_table(spark.createDataFrame([(1, "A"), (2, "B")], "dept_id int, dept_name string"), f"{source}/dim_department")
    assert contracts.load_table(spark, source, target, "dim_department") == 2
    assert contracts.load_table(spark, source, target, "dim_department") == 0
    assert contracts.read_loaded(spark, target, "dim_department").count() == 2
    write_table(spark.createDataFrame([(3, "C")], "dept_id int, dept_name string"), f"{tmp_path}/more/dim_department")
    assert contracts.load_table(spark, f"{tmp_path}/more", target, "dim_department") == 1
    loaded = contracts.read_loaded(spark, target, "dim_department")
    assert loaded.columns == [f.name for f in contracts.CONTRACTS["dim_department"]]
    assert sorted(r.dept_id for r in loaded.collect()) == [1, 2, 3]
    assert loaded.select("dept_key").distinct().count() == 3


def test_a_load_without_its_record_is_repeated(spark, tmp_path):
    source, target = str(tmp_path / "gold"), str(tmp_path / "warehouse")
    rows = spark.createDataFrame([("2024-01", "A", 1), (None, "B", 2)], "budget_month_key string, invoice_id string, vendor_id int")
    write_table(rows, f"{source}/fact_expense", partition_by="budget_month_key")
    stray = contracts.conform(rows.limit(1), "fact_expense")  # left by a load that failed before its record
    write_table(stray, f"{target}/fact_expense/load_number=1", partition_by="budget_month_key")
    assert contracts.load_table(spark, source, target, "fact_expense") == 2
    loaded = contracts.read_loaded(spark, target, "fact_expense")
    assert sorted((r.budget_month_key or "", r.invoice_id) for r in loaded.collect()) == [("", "B"), ("2024-01", "A")]
    plan = loaded.filter("budget_month_key = '2024-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(budget_month_key" in plan


def test_summaries_load_with_totals_of_any_size(spark, tmp_path):
    rows = spark.createDataFrame([(1, "A", Decimal("12345678901.00"), 2)], "dept_id int, dept_name string, total_expenses decimal(20,2), expense_count int")
    write_table(rows, f"{tmp_path}/gold/summary_dept_expenses")
    assert contracts.load_table(spark, f"{tmp_path}/gold", f"{tmp_path}/w", "summary_dept_expenses") == 1


def test_budgets_without_a_month_are_kept_apart(spark):
    rows = spark.createDataFrame([(1, "A", "2024-01", Decimal("5")), (1, "A", None, Decimal("6"))], "dept_id int, dept_name string, budget_month string, budget_amount decimal(12,2)")
    assert contracts.fact_budget(rows).count() == 1 and contracts.budgets_without_month(rows).count() == 1


def test_other_read_errors_are_no_reason_to_fall_back(spark, tmp_path):
    (tmp_path / "b").mkdir()
    with pytest.raises(AnalysisException):
        load_budgets(spark, str(tmp_path / "b"))


def test_a_clustered_table_skips_files_by_date(spark, tmp_path):
    days = spark.range(2000).selectExpr("date_add(date'2024-01-01', cast(id % 100 as int)) AS d", "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files, for all that the table is small
    write_table(days, str(tmp_path / "t"), cluster_by=("d", "id"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = [r[0:2] for r in read_table(spark, str(tmp_path / "t")).groupBy(F.input_file_name()).agg(F.min("d").alias("a"), F.max("d").alias("b")).select("a", "b").collect()]
    assert len(spans) > 1 and sum(a <= date(2024, 1, 1) <= b for a, b in spans) == 1
