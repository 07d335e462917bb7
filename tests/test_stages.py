from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from outlay import schemas
from outlay.operators import quality
from outlay.params import Thresholds
from outlay.plans import stages
from outlay.sources import contracts
from outlay.sources.calendar import calendar_between
from outlay.sources.readers import read_table


def csv_line(*values):
    return ",".join("" if v is None else str(v) for v in values) + "\n"


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """Raw files in the shape of the sample data, with duplicates and broken rows."""
    rng = random.Random(42)
    root = tmp_path_factory.mktemp("lake")
    raw = root / "raw"
    raw.mkdir()
    start = date(2024, 1, 1)

    with open(raw / "expenses_small.csv", "w") as out:
        out.write(csv_line(*schemas.EXPENSES.names))
        for i in range(300):
            vendor, employee, dept = rng.randint(1, 10), rng.randint(1, 20), rng.randint(1, 4)
            amount = rng.choice([rng.randint(1, 20) * 100, round(rng.uniform(5, 5000), 2), 42.5])
            line = csv_line(
                f"INV-{i:05d}", vendor, f"Vendor {vendor}", employee, f"Employee {employee}", dept, f"Dept {dept}",
                start + timedelta(rng.randint(0, 120)), amount, "USD", "Wire", "text",
            )
            out.write(line)
            if i % 50 == 0:
                out.write(line)
        out.write(csv_line(None, 1, "V", 1, "E", 1, "D", "2024-01-01", 5, "USD", "Wire", "no id"))
        out.write(csv_line("BAD", 1, "V", 1, "E", 1, "D", "2024-01-01", -5, "USD", "Wire", "credit"))
    with open(raw / "budgets_small.csv", "w") as out:
        out.write(csv_line(*schemas.BUDGETS.names))
        for dept in range(1, 5):
            for month in range(1, 5):
                out.write(csv_line(dept, f"Dept {dept}", f"2024-{month:02d}", 20000, "USD"))
        out.write(csv_line(1, "Dept 1", None, 30000, "USD"))
    with open(raw / "campaign_spend_small.csv", "w") as out:
        out.write(csv_line(*schemas.CAMPAIGN_SPEND.names))
        for i in range(120):
            campaign = rng.randint(1, 5)
            out.write(csv_line(
                f"SPEND-{i:06d}", campaign, f"Campaign_{campaign}", "Web", "Sales", start + timedelta(rng.randint(0, 90)),
                round(rng.uniform(100, 5000), 2), rng.randint(10, 1000), rng.randint(1000, 9999), rng.randint(0, 50),
                round(rng.uniform(0, 9000), 2),
            ))
    calendar_between(spark, "2024-01-01", "2024-03-31", schemas.HOLIDAYS_2024).toPandas().to_csv(
        raw / "holidays.csv", index=False
    )
    return str(raw), str(root / "clean"), str(root / "gold"), str(root)


def test_the_stages_run_end_to_end(spark, folders):
    raw, clean, gold, root = folders
    as_of = F.lit("2024-04-30").cast("date")
    counts = stages.run_all(spark, raw, clean, gold, Thresholds(sub_threshold_amount=50), as_of)
    assert {k: counts[k] for k in ("expenses", "budgets", "campaign_spend", "holidays")} == {
        "expenses": 300, "budgets": 17, "campaign_spend": 120, "holidays": 91,
    }
    assert {k: counts[k] for k in counts if k.startswith("dim_")} == {
        "dim_vendor": 10, "dim_employee": 20, "dim_department": 4, "dim_campaign": 5, "dim_calendar": 91,
    }
    assert (counts["fact_expense"], counts["fact_campaign_spend"], counts["fact_budget"]) == (300, 120, 16)
    assert counts["fact_budget_rejects"] == 1 and counts["vendor_rank"] == 10
    rejected = {(r.table_name, r.reason): r.row_count for r in read_table(spark, f"{clean}/rejects").collect()}
    assert rejected == {("expenses", "invoice_id missing"): 1, ("expenses", "amount not positive"): 1}
    intake = {(r.table_name, r.status): r.row_count for r in read_table(spark, f"{clean}/intake").groupBy("table_name", "status").agg(F.sum("row_count").alias("row_count")).collect()}
    assert {s: intake["expenses", s] for s in ("clean", "duplicate", "rejected")} == {"clean": 300, "duplicate": 6, "rejected": 2}
    lines = {r.reason: r.raw_line for r in read_table(spark, f"{clean}/quarantine").collect()}
    assert lines["amount not positive"].startswith("BAD,1,V,1,E,1,D,2024-01-01,-5,")
    assert counts["summary_dept_expenses"] == 4 and counts["kpi_vendor_concentration"] == 10

    fact = read_table(spark, f"{gold}/fact_expense")
    assert fact.select("expense_id").distinct().count() == 300
    late = fact.filter("budget_month_key IS NULL")
    assert late.count() > 0 and late.filter("trx_date <= '2024-03-31'").count() == 0
    known = fact.join(read_table(spark, f"{gold}/dim_vendor"), ["vendor_id", "vendor_key"], "left_anti")
    assert known.count() == 0

    signals = read_table(spark, f"{gold}/fact_leakage_signal")
    assert signals.count() == counts["fact_leakage_signal"] == signals.select("signal_id").distinct().count()
    rules = {r.rule_name for r in signals.select("rule_name").distinct().collect()}
    assert rules == {
        "duplicate_invoice", "sub_threshold_repeats", "weekend_holiday_claim", "round_number_spikes",
        "campaign_spend_spike",
    }

    report = stages.report(spark, gold, f"{root}/report")
    values = {(r.section, r.metric): r.value for r in report.filter("item IS NULL").collect()}
    assert values["expenses", "total_transactions"] == 300.0
    assert values["leakage_detection", "total_signals"] == counts["fact_leakage_signal"]

    results = stages.check_quality(spark, clean, gold)
    failed = [(r.table_name, r.check_name) for r in results.filter("NOT passed").collect()]
    assert failed == [("silver.budgets", "budget_month_not_null"), ("silver.budgets", "dept_month_unique")]
    assert quality.summarize(results).first().total_checks == 9 + 6 + 6 + 9
    assert quality.exit_code(results) == 1

    loaded = contracts.load_all(spark, gold, f"{root}/warehouse")
    assert loaded == {t: counts[t] for t in contracts.LOADED_TABLES}
    assert set(contracts.load_all(spark, gold, f"{root}/warehouse").values()) == {0}
    before = {t: contracts.read_loaded(spark, f"{root}/warehouse", t).count() for t in contracts.LOADED_TABLES}
    stages.build_star(spark, clean, gold)
    stages.build_summaries(spark, gold)
    again = contracts.load_all(spark, gold, f"{root}/warehouse")
    assert {t: n for t, n in again.items() if n and t not in contracts.NATURAL} == {}
    assert {t: contracts.read_loaded(spark, f"{root}/warehouse", t).count() for t in contracts.LOADED_TABLES} == before == loaded


def test_the_star_needs_a_budget_table(spark, folders, tmp_path):
    _, clean, _, _ = folders
    for table in ("expenses", "campaign_spend", "holidays"):
        read_table(spark, f"{clean}/{table}").write.parquet(str(tmp_path / "clean" / table))
    with pytest.raises(AnalysisException):
        stages.build_star(spark, str(tmp_path / "clean"), str(tmp_path / "gold"))


def test_a_repeated_stage_gives_the_same_keys(spark, folders, tmp_path):
    raw, clean, gold, _ = folders
    stages.build_star(spark, clean, str(tmp_path / "gold"))
    for table, key in (("dim_vendor", "vendor_key"), ("dim_employee", "employee_key"), ("dim_calendar", "calendar_key")):
        first, again = read_table(spark, f"{gold}/{table}"), read_table(spark, str(tmp_path / "gold" / table))
        assert sorted(first.collect()) == sorted(again.collect()), key
