from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rows import as_dicts, day
from outlay.operators import insights, kpis, metrics, quality, views
from outlay.sources.calendar import calendar_between
from outlay.sources.ranked import read_ranked, write_ranked
from outlay.sources.readers import fallback_budgets


def ranked(tmp_path, fact, vendors):
    write_ranked(views.vendor_shares(fact, vendors), views.RANK_ORDER, str(tmp_path / "vendor_rank"))
    return read_ranked(fact.sparkSession, str(tmp_path / "vendor_rank"), "vendor_rank")


def budgets(spark, *rows):
    return spark.createDataFrame(
        [(d, m, Decimal(str(a))) for d, m, a in rows], "dept_id int, budget_month string, budget_amount decimal(12,2)"
    )


def signals(spark, *rows):
    return spark.createDataFrame(
        [(r, e, "1", "N", day(t) if t else None, s, "x") for r, e, t, s in rows],
        "rule_name string, entity_type string, entity_id string, entity_name string, signal_date date, "
        "score double, details string",
    )


def test_vendor_concentration_scores(fact, names):
    df = fact(("A", 1, 1, 1, "2024-01-01", 30), ("B", 2, 1, 1, "2024-01-01", 4), ("C", 1, 1, 1, "2024-01-01", 46))
    rows = kpis.vendor_concentration(df, names("vendor_id", "vendor_name", 1, 2)).collect()
    assert [(r.vendor_id, r.spend_percentage, r.concentration_score) for r in rows] == [
        (1, 95.0, 90.0), (2, 5.0, 50.0),
    ]
    assert rows[0].total_spend == Decimal("76.00") and rows[0].transaction_count == 2


def test_concentration_limits_are_exclusive(fact, names):
    df = fact(*[(f"A{v}", v, 1, 1, "2024-01-01", a) for v, a in enumerate((10, 5, 2, 83), 1)])
    rows = kpis.vendor_concentration(df, names("vendor_id", "vendor_name", 1)).collect()
    assert {r.vendor_id: r.concentration_score for r in rows} == {1: 70.0, 2: 50.0, 3: 20.0, 4: 90.0}


def test_budget_variance_is_driven_by_spending(spark, fact, names):
    df = fact(("A", 1, 1, 1, "2024-01-01", 110), ("B", 1, 1, 2, "2024-01-01", 50), ("C", 1, 1, 1, None, 7))
    out = kpis.budget_variance(
        df, names("dept_id", "dept_name", 1, 2), budgets(spark, (1, "2024-01", 100), (1, "2024-02", 100))
    )
    rows = {(r.dept_id, r.budget_month_key): r for r in out.collect()}
    assert set(rows) == {(1, "2024-01"), (2, "2024-01"), (1, None)}
    assert rows[1, "2024-01"].variance_amount == Decimal("10.00")
    assert rows[1, "2024-01"].variance_percentage == 10.0
    assert (rows[2, "2024-01"].budget_amount, rows[2, "2024-01"].variance_percentage) == (Decimal("0.00"), 0.0)
    assert kpis.budget_variance(df, names("dept_id", "dept_name", 1), fallback_budgets(spark)).count() == 3


def test_budget_view_is_driven_by_budgets(spark, fact, names):
    df = fact(("A", 1, 1, 1, "2024-01-01", 110.01), ("B", 1, 1, 1, "2024-02-01", 89.99), ("C", 1, 1, 1, "2024-03-01", 110))
    view = views.budget_vs_actual(
        budgets(spark, (1, "2024-01", 100), (1, "2024-02", 100), (1, "2024-03", 100), (1, "2024-04", 100), (9, "2024-01", 5)),
        df, names("dept_id", "dept_name", 1),
    )
    rows = {(r.dept_id, r.budget_month): r for r in view.collect()}
    assert {k: r.budget_status for k, r in rows.items()} == {
        (1, "2024-01"): "Over Budget", (1, "2024-02"): "Under Budget", (1, "2024-03"): "On Target",
        (1, "2024-04"): "Under Budget", (None, "2024-01"): "Under Budget",
    }
    assert rows[1, "2024-04"].actual_amount == Decimal("0.00")


def test_vendor_view_ranks_and_shares_the_whole_total(spark, fact, tmp_path):
    df = fact(*[(f"A{v}", v, 1, 1, "2024-01-01", a) for v, a in ((1, 20), (2, 30), (3, 30), (4, 20))])
    vendors = spark.createDataFrame(
        [(1, "V1", "T"), (2, "V2", "T"), (3, "V3", "T")], "vendor_id int, vendor_name string, category string"
    )
    rows = views.vendor_concentration(ranked(tmp_path, df, vendors)).collect()
    assert [(r.vendor_rank, r.vendor_id, r.spend_percentage) for r in rows] == [
        (1, 2, 30.0), (2, 3, 30.0), (3, 1, 20.0),
    ]
    assert {r.concentration_risk for r in rows} == {"High Risk"}


def test_leakage_view_counts_recent_signals(spark):
    df = signals(
        spark, ("a", "vendor", "2024-03-31", 80.0), ("a", "vendor", "2024-03-30", 90.0),
        ("a", "vendor", "2024-06-30", 60.0), ("b", "vendor", "2024-06-01", 59.0), ("c", "employee", "2024-06-01", 39.0),
    )
    as_of = F.lit("2024-06-30").cast("date")
    rows = views.leakage_flags(df, as_of).collect()
    assert [(r.rule_name, r.signal_date.isoformat(), r.risk_level, r.rule_count, r.entity_type_count) for r in rows] == [
        ("a", "2024-03-30", "Critical", 3, 4), ("a", "2024-03-31", "Critical", 3, 4),
        ("a", "2024-06-30", "High", 3, 4), ("b", "2024-06-01", "Medium", 1, 4), ("c", "2024-06-01", "Low", 1, 1),
    ]
    unknown = signals(spark, ("a", None, "2024-06-01", 80.0), ("b", None, "2024-06-02", 80.0), (None, "vendor", "2024-06-03", 80.0))
    assert [(r.rule_count, r.entity_type_count) for r in views.leakage_flags(unknown, as_of).collect()] == [(1, 1), (1, 2), (1, 2)]
    later = views.leakage_flags(df, F.lit("2024-07-01").cast("date")).collect()
    assert len(later) == 3  # from 2024-04-01 on


def test_campaign_view_guards_its_ratios(spark):
    fact = spark.createDataFrame(
        [("S1", 1, Decimal("10"), 2, 100, 1, Decimal("30.01")), ("S2", 2, Decimal("10"), 0, 0, 0, Decimal("20"))],
        "spend_id string, campaign_id int, cost decimal(10,2), clicks int, impressions int, conversions int, "
        "attributed_revenue decimal(10,2)",
    )
    dim = spark.createDataFrame(
        [(1, "C1", "Web", "Sales"), (2, "C2", "TV", "Reach")],
        "campaign_id int, campaign_name string, channel string, objective string",
    )
    rows = {r.campaign_id: r for r in views.campaign_roi(fact, dim).collect()}
    assert (rows[1].roi_category, rows[1].ctr_percentage, rows[1].conversion_rate) == ("Excellent", 2.0, 50.0)
    assert (rows[2].roi_category, rows[2].ctr_percentage, rows[2].conversion_rate) == ("Break-even", 0.0, 0.0)


def test_trend_view_compares_with_the_previous_present_month(spark, fact):
    df = fact(("A", 1, 1, 1, "2024-01-01", 100), ("B", 1, 1, 2, "2024-01-09", 100), ("C", 1, 1, 1, "2024-03-01", 150))
    same_name = spark.createDataFrame([(1, "D"), (2, "D")], "dept_id int, dept_name string")
    rows = [tuple(r) for r in views.monthly_expense_trends(df, same_name).collect()]
    assert rows == [
        ("2024-01", "D", Decimal("200.00"), 2, 100.0, None, 0.0),
        ("2024-03", "D", Decimal("150.00"), 1, 150.0, Decimal("200.00"), -25.0),
    ]


def test_employee_view(spark, fact, names):
    df = fact(
        ("A", 1, 1, 1, "2024-01-06", 100), ("B", 2, 1, 1, "2024-01-08", 250.5), ("C", 2, 1, 1, "2024-01-09", 300),
        ("D", 9, 1, 1, "2024-01-09", 1), ("E", 1, 1, 1, "2025-01-09", 1),
    )
    view = views.employee_expense_analysis(
        df, names("employee_id", "employee_name", 1), names("dept_id", "dept_name", 1),
        names("vendor_id", "vendor_name", 1, 2), calendar_between(spark, "2024-01-01", "2024-12-31"),
    )
    assert [tuple(r) for r in view.collect()] == [(
        "Employee 1", 1, "Dept 1", 3, Decimal("650.50"), 650.5 / 3, Decimal("300.00"), day("2024-01-06"),
        day("2024-01-09"), 2, 1, 2,
    )]


def test_risk_dashboard_and_registered_views(spark, fact, names, tmp_path):
    df = fact(("A", 1, 1, 1, "2024-01-01", 150), ("B", 2, 1, 2, "2024-01-01", 8))
    vendors = spark.createDataFrame([(1, "V1", "T"), (2, "V2", "T")], "vendor_id int, vendor_name string, category string")
    campaign = spark.createDataFrame(
        [("S", 1, day("2024-01-01"), Decimal("1"), 1, 1, 1, Decimal("1"))],
        "spend_id string, campaign_id int, date date, cost decimal(10,2), clicks int, impressions int, "
        "conversions int, attributed_revenue decimal(10,2)",
    )
    gold = {
        "fact_expense": df, "fact_campaign_spend": campaign, "fact_leakage_signal": signals(
            spark, ("a", "vendor", "2024-01-01", 80.0), ("a", "vendor", "2024-01-01", 40.0), ("a", "vendor", "2023-01-01", 80.0)
        ),
        "fact_budget": budgets(spark, (1, "2024-01", 100), (2, "2024-01", 8), (2, "2024-02", 5)),
        "dim_vendor": vendors, "dim_department": names("dept_id", "dept_name", 1, 2),
        "dim_employee": names("employee_id", "employee_name", 1),
        "dim_campaign": spark.createDataFrame([(1, "C", "W", "S")], "campaign_id int, campaign_name string, channel string, objective string"),
        "dim_calendar": calendar_between(spark, "2024-01-01", "2024-01-31"),
        "vendor_rank": ranked(tmp_path, df, vendors),
    }
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup())
    created = views.register_views(spark, gold, F.lit("2024-02-01").cast("date"))
    assert set(tracker.getJobIdsForGroup()) == before
    assert len(created) == 7
    rows = {r.metric_type: (r.high_risk_count, r.normal_count, r.low_risk_count) for r in spark.table("vw_risk_dashboard").collect()}
    assert rows == {"Budget Variance": (1, 1, 1), "Vendor Concentration": (1, 1, 0), "Leakage Signals": (1, 1, 0)}
    top = spark.sql("SELECT vendor_id FROM vw_vendor_concentration WHERE vendor_rank = 1").collect()
    assert [r.vendor_id for r in top] == [1]
    for name in created:
        assert spark.table(name).count() > 0
        spark.catalog.dropTempView(name)


def test_quality_suites(spark):
    df = spark.createDataFrame(
        [("A", Decimal("0.001"), day("2024-01-01"), 1, 1, 1), ("A", Decimal("-5"), None, None, 1, 1),
         (None, Decimal("2000000"), day("2024-01-01"), 1, None, 1), (None, None, day("2024-01-01"), 1, 1, 1)],
        "invoice_id string, amount decimal(12,3), trx_date date, vendor_id int, employee_id int, dept_id int",
    )
    rows = {r.check_name: r for r in quality.check_expenses(df, "t").collect()}
    assert {n: (r.passed, r.failed_rows) for n, r in rows.items()} == {
        "invoice_id_not_null": (False, 2), "invoice_id_unique": (False, 2), "amount_positive": (False, 1),
        "amount_range": (False, 3), "trx_date_not_null": (False, 1), "vendor_id_not_null": (False, 1),
        "employee_id_not_null": (False, 1), "dept_id_not_null": (True, 0), "min_rows": (True, None),
    }
    assert rows["invoice_id_not_null"].message == "t.invoice_id: 2 nulls (50.00%)"
    assert rows["amount_range"].message == "t.amount: 3 values outside range [0.01, 1000000.0]"
    assert rows["min_rows"].message == "t: 4 rows (minimum: 1)"
    assert rows["invoice_id_not_null"].failed_pct == 50.0
    results = quality.check_expenses(df, "t")
    assert as_dicts(quality.summarize(results)) == [
        {"total_checks": 9, "passed": 2, "failed": 7, "pass_rate": pytest.approx(2 / 9 * 100)}
    ]
    assert quality.exit_code(results) == 1
    assert quality.exit_code(results.filter("passed")) == 0


def test_quality_of_empty_and_multi_month_tables(spark):
    empty = budgets(spark)
    rows = {r.check_name: (r.passed, r.failed_pct) for r in quality.check_budgets(empty).collect()}
    assert rows["min_rows"][0] is False and rows["dept_id_not_null"] == (True, 0.0)
    months = budgets(spark, (1, "2024-01", 5), (1, "2024-02", 5), (2, "2024-01", 5))
    rows = {r.check_name: (r.passed, r.failed_rows) for r in quality.check_budgets(months).collect()}
    assert rows["dept_month_unique"] == (False, 1)
    assert rows["dept_id_budget_month_unique"] == (True, 0)


def test_metrics_and_report(spark, fact, names):
    df = fact(("A", 1, 1, 1, "2024-01-01", 120), ("B", 2, 1, 2, "2024-01-02", 80))
    marks = signals(spark, ("a", "vendor", "2024-01-01", 80.0), ("a", "vendor", "2024-01-01", 75.0),
                    ("b", "vendor", "2024-01-01", 60.0), ("b", "vendor", "2024-01-01", 45.0))
    variance = kpis.budget_variance(df, names("dept_id", "dept_name", 1, 2), budgets(spark, (1, "2024-01", 100), (2, "2024-01", 100)))
    shares = kpis.vendor_concentration(df, names("vendor_id", "vendor_name", 1, 2))
    assert as_dicts(metrics.expense_metrics(df)) == [{
        "total_transactions": 2, "total_expenses": 200.0, "avg_transaction_amount": 100.0,
        "max_transaction_amount": 120.0, "min_transaction_amount": 80.0,
    }]
    per_rule = metrics.signals_per_rule(marks)
    assert as_dicts(metrics.signal_metrics(per_rule)) == [{
        "total_signals": 4, "high_risk_signals": 1, "medium_risk_signals": 2, "low_risk_signals": 1,
        "total_risk_score": 260.0, "avg_risk_score": 65.0,
    }]
    assert {tuple(r) for r in metrics.rule_counts(per_rule).collect()} == {("a", 2), ("b", 2)}
    assert as_dicts(metrics.budget_metrics(variance)) == [{
        "total_budget": 200.0, "total_actual": 200.0, "total_variance": 0.0, "avg_variance_pct": 0.0,
        "over_budget_departments": 1, "under_budget_departments": 1,
    }]
    assert as_dicts(metrics.vendor_metrics(shares)) == [{
        "total_vendors": 2, "total_vendor_spend": 200.0, "avg_spend_percentage": 50.0,
        "max_spend_percentage": 60.0, "high_risk_vendors": 2,
    }]
    estimate = metrics.leakage_estimate(metrics.expense_metrics(df), metrics.signal_metrics(per_rule))
    assert as_dicts(estimate) == [{"estimated_potential_leakage": 50.0, "leakage_percentage": 25.0}]
    report = metrics.metrics_report(df, marks, variance, shares)
    values = {(r.section, r["item"], r.metric): r.value for r in report.collect()}
    assert values["top_vendors", "Vendor 1", "spend_percentage"] == 60.0
    assert values["leakage_by_rule", "b", "signal_count"] == 2.0
    assert values["leakage_estimate", None, "leakage_percentage"] == 25.0
    assert len(values) == 5 + 5 + 2 + 6 + 5 + 6 + 2


def test_metrics_of_empty_tables_are_zero(spark, fact):
    none = metrics.signal_metrics(metrics.signals_per_rule(signals(spark)))
    assert as_dicts(none)[0]["total_signals"] == 0 and as_dicts(none)[0]["avg_risk_score"] == 0.0
    estimate = metrics.leakage_estimate(metrics.expense_metrics(fact(("A", 1, 1, 1, "2024-01-01", 1)).limit(0)), none)
    assert as_dicts(estimate) == [{"estimated_potential_leakage": 0.0, "leakage_percentage": 0.0}]


def test_insights_over_signals(spark):
    start = date(2024, 1, 1)
    rows = [("a", "vendor", (start + timedelta(d)).isoformat(), s) for d, s in [(0, 90.0), (1, 75.0), (1, 75.0), (5, 45.0)]]
    df = signals(spark, *rows, ("b", "vendor", "2024-01-06", 100.0))
    assert [tuple(r) for r in insights.signals_by_rule(df).collect()] == [("a", 4, 80.0), ("b", 1, 20.0)]
    assert as_dicts(insights.signals_by_rule_figures(df)) == [{
        "total_signals": 5, "top_rule": "a", "top_rule_signals": 4, "top_rule_pct": 80.0, "active_rules": 2,
        "mean_per_rule": 2.5,
    }]
    assert [tuple(r) for r in insights.score_histogram(df).collect()] == [
        (10, 45.0, 1), (16, 75.0, 2), (19, 90.0, 1), (21, 100.0, 1),
    ]
    figures = as_dicts(insights.score_figures(df))[0]
    assert figures["mean_score"] == 77.0 and figures["median_score"] == 75.0
    assert figures["stddev_score"] == pytest.approx(20.796634, abs=1e-6)
    assert (figures["high_count"], figures["medium_pct"], figures["low_count"]) == (2, 40.0, 1)
    assert as_dicts(insights.signals_over_time_figures(df)) == [{
        "first_day": start, "last_day": date(2024, 1, 6), "mean_per_day": pytest.approx(5 / 3),
        "peak_day": date(2024, 1, 2), "peak_signals": 2, "active_days": 3, "trend": "Increasing",
    }]
    assert {r.rule_name for r in insights.rule_names(df).collect()} == {"a", "b"}
    counts = {b: insights.filter_signals(df, b).count() for b in (None, "Critical", "High", "Medium", "Low")}
    assert counts == {None: 5, "Critical": 2, "High": 2, "Medium": 1, "Low": 0}
    assert insights.filter_signals(df, "Critical", "b").count() == 1


def test_insights_over_spending(spark, fact, names):
    df = fact(
        ("A", 1, 1, 1, "2024-01-01", 10), ("B", 2, 1, 1, "2024-02-01", 30), ("C", 3, 1, 2, "2024-03-01", 30),
        ("D", 3, 1, 2, None, 5),
    )
    assert [tuple(r) for r in insights.monthly_expenses(df).collect()] == [
        ("2024-01", Decimal("10.00")), ("2024-02", Decimal("30.00")), ("2024-03", Decimal("30.00")),
    ]
    figures = as_dicts(insights.monthly_expense_figures(df))[0]
    assert (figures["months"], figures["highest_month"], figures["lowest_month"]) == (3, "2024-02", "2024-01")
    assert figures["volatility"] == pytest.approx(11.547005, abs=1e-6)
    variance = kpis.budget_variance(
        df, names("dept_id", "dept_name", 1, 2), budgets(spark, (1, "2024-01", 10), (1, "2024-02", 20), (2, "2024-03", 100))
    )
    bands = as_dicts(insights.budget_variance_figures(variance))[0]
    assert (bands["over_budget"], bands["under_budget"], bands["on_target"]) == (1, 1, 2)
    assert (bands["on_target_pct"], bands["highest_department"], bands["highest_variance_pct"]) == (50.0, "Dept 1", 50.0)
    months = as_dicts(insights.monthly_budget_figures(variance))[0]
    assert (months["total_budget"], months["total_actual"], months["months"]) == (Decimal("130.00"), Decimal("70.00"), 3)
    assert months["overall_variance_pct"] == pytest.approx(-60 / 130 * 100)
    shares = kpis.vendor_concentration(df, names("vendor_id", "vendor_name", 1, 2, 3))
    assert [r.vendor_id for r in insights.top_vendors(shares, 2).collect()] == [3, 2]
    listed = as_dicts(insights.top_vendor_figures(shares, 2))[0]
    assert (listed["top_vendor"], listed["total_vendors"]) == ("Vendor 3", 3)
    assert listed["listed_share_pct"] == pytest.approx(65 / 75 * 100)
    assert {(r.risk_band, r.vendor_count) for r in insights.vendor_risk_split(shares).collect()} == {("High", 3)}
    head = as_dicts(insights.headline(df, signals(spark, ("a", "vendor", None, 80.0)), shares))[0]
    assert head == {
        "leakage_signals": 1, "high_risk_signals": 1, "total_expenses": Decimal("75.00"), "active_vendors": 3,
    }


def test_several_distinct_counts_copy_no_rows(spark):
    df = spark.createDataFrame(
        [(d, m, Decimal("5")) for d, m in ((1, "a"), (1, "b"), (1, "b"), (None, "a"), (None, "a"), (2, None), (2, None))],
        "dept_id int, budget_month string, budget_amount decimal(12,2)")
    results = quality.check_budgets(df, "t")
    assert "Expand" not in results._jdf.queryExecution().optimizedPlan().toString()
    found = {r.check_name: (r.failed_rows, r.passed) for r in results.collect()}
    assert found["dept_month_unique"] == (4, False) and found["dept_id_budget_month_unique"] == (3, False)
    empty = {r.check_name: r.failed_rows for r in quality.check_budgets(df.limit(0), "t").collect()}
    assert empty["dept_month_unique"] == 0
