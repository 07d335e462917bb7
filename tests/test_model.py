from __future__ import annotations

from decimal import Decimal

from rows import as_dicts, day, expense
from outlay import schemas
from outlay.operators import dimensions, facts, summaries
from outlay.operators.cleaning import clean_calendar
from outlay.sources.calendar import calendar_between


def test_dimensions_hold_one_row_per_id_with_dense_keys(expenses):
    df = expenses(
        expense("A", 9, 4, 2, "2024-01-15", 1), expense("B", 3, 4, 1, "2024-01-15", 1),
        expense("C", 9, 5, 1, "2024-01-15", 1, vendor_name="Another"),
        expense("D", None, 5, 1, "2024-01-15", 1),
    )
    vendors = {r["vendor_id"]: r for r in as_dicts(dimensions.dim_vendor(df))}
    assert {v: r["vendor_key"] for v, r in vendors.items()} == {None: 1, 3: 2, 9: 3}
    assert vendors[9] == {
        "vendor_id": 9, "vendor_name": "Another", "category": "Technology", "country": "US", "vendor_key": 3,
    }
    employees = {r["employee_id"]: r for r in as_dicts(dimensions.dim_employee(df))}
    assert employees[4]["dept_id"] == 1 and employees[4]["title"] == "Employee"
    assert employees[4]["location"] == "Remote" and employees[5]["employee_key"] == 2
    departments = as_dicts(dimensions.dim_department(df).orderBy("dept_id"))
    assert [(r["dept_id"], r["owner"], r["dept_key"]) for r in departments] == [
        (1, "Owner_Dept 1", 1), (2, "Owner_Dept 2", 2),
    ]


def test_campaign_and_calendar_dimensions(spark):
    rows = [(f"S{i}", c, f"C{c}", ch, "Sales", day("2024-01-01"), Decimal("1"), 1, 1, 1, Decimal("1"))
            for i, (c, ch) in enumerate([(8, "Web"), (8, "Mail"), (2, "TV")])]
    campaigns = dimensions.dim_campaign(spark.createDataFrame(rows, schemas.CAMPAIGN_SPEND))
    assert {(r.campaign_id, r.channel, r.campaign_key) for r in campaigns.collect()} == {(2, "TV", 1), (8, "Mail", 2)}
    calendar = dimensions.dim_calendar(calendar_between(spark, "2024-01-01", "2024-01-31"))
    assert {r.date.day: r.calendar_key for r in calendar.collect()} == {d: d for d in range(1, 32)}


def test_facts_carry_keys_and_the_calendar_month(spark, expenses):
    df = expenses(expense("A", 9, 4, 2, "2024-01-15", 10), expense("B", None, 4, 2, "2025-06-01", 20))
    calendar = dimensions.dim_calendar(calendar_between(spark, "2024-01-01", "2024-12-31"))
    fact = facts.fact_expense(
        df, dimensions.dim_vendor(df), dimensions.dim_employee(df), dimensions.dim_department(df), calendar
    )
    rows = {r.invoice_id: r for r in fact.collect()}
    assert (rows["A"].budget_month_key, rows["A"].vendor_key, rows["A"].calendar_key) == ("2024-01", 2, 15)
    assert (rows["B"].budget_month_key, rows["B"].vendor_key, rows["B"].calendar_key) == (None, None, None)
    assert rows["B"].employee_key == 1 and rows["B"].dept_key == 1
    assert len(fact.columns) == 14


def test_unused_dimension_joins_leave_the_plan(spark, expenses):
    df = expenses(expense("A", 9, 4, 2, "2024-01-15", 10))
    calendar = dimensions.dim_calendar(clean_calendar(calendar_between(spark, "2024-01-01", "2024-12-31")))
    fact = facts.fact_expense(
        df, dimensions.dim_vendor(df), dimensions.dim_employee(df), dimensions.dim_department(df), calendar
    )
    plan = fact.agg({"amount": "sum"})._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan and "Join" not in plan


def test_summaries(spark, fact, names):
    df = fact(
        ("A", 1, 1, 1, "2024-01-01", 10), ("B", 1, 1, 2, "2024-01-02", 20), ("C", 1, 1, 1, "2024-02-01", 1),
        ("D", 1, 1, 9, "2024-02-01", 100),
    )
    monthly = [tuple(r) for r in summaries.monthly_expenses(df).collect()]
    assert monthly == [
        ("2024-01", Decimal("30.00"), 2, Decimal("15.000000")), ("2024-02", Decimal("101.00"), 2, Decimal("50.500000")),
    ]
    dept = summaries.dept_expenses(df, names("dept_id", "dept_name", 1, 2))
    assert [tuple(r) for r in dept.collect()] == [
        (9, None, Decimal("100.00"), 1), (2, "Dept 2", Decimal("20.00"), 1), (1, "Dept 1", Decimal("11.00"), 2),
    ]


def test_campaign_summary_leaves_out_campaigns_without_cost(spark):
    rows = [("S1", 1, Decimal("10"), 5, 1, Decimal("30")), ("S2", 1, Decimal("10"), 5, 2, Decimal("10")),
            ("S3", 2, Decimal("0"), 5, 2, Decimal("10")), ("S4", 3, Decimal("4"), None, None, None)]
    df = spark.createDataFrame(
        rows, "spend_id string, campaign_id int, cost decimal(10,2), clicks int, conversions int, "
        "attributed_revenue decimal(10,2)",
    )
    assert [tuple(r) for r in summaries.campaign_performance(df).collect()] == [
        (1, Decimal("20.00"), 10, 3, Decimal("40.00"), 2.0), (3, Decimal("4.00"), None, None, None, None),
    ]
