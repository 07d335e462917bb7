from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rows import day
from outlay.operators import rules
from outlay.operators import near_duplicates
from outlay.operators.near_duplicates import near_duplicate_points
from outlay.params import Thresholds
from outlay.schemas import SIGNAL_COLUMNS
from outlay.sources.calendar import calendar_between


def test_duplicate_invoices_flag_every_expense_of_a_repeating_vendor(fact, names):
    df = fact(
        ("K-1", 1, 7, 3, "2023-09-02", 18.5), ("K-2", 1, 4, 3, "2023-09-29", 7400),
        ("K-3", 2, 4, 1, "2023-09-10", 18.5),
        # 30 days apart counts, 31 does not; three in a window still score 75.
        ("INV-004", 3, 1, 1, "2024-03-01", 1), ("INV-005", 3, 1, 1, "2024-03-31", 9),
        ("INV-006", 4, 1, 1, "2024-03-01", 1), ("INV-007", 4, 1, 1, "2024-04-01", 1),
        ("INV-008", 5, 1, 1, "2024-03-01", 1), ("INV-009", 5, 1, 1, "2024-03-01", 1),
        ("INV-010", 5, 1, 1, "2024-03-02", 1),
    )
    out = rules.duplicate_invoices(df, names("vendor_id", "vendor_name", 1, 2, 3, 4))
    assert tuple(out.columns) == SIGNAL_COLUMNS
    rows = out.collect()
    assert Counter((r.entity_id, r.signal_date) for r in rows) == {
        ("1", day("2023-09-02")): 1, ("1", day("2023-09-29")): 1, ("3", day("2024-03-01")): 1,
        ("3", day("2024-03-31")): 1, ("5", day("2024-03-01")): 2, ("5", day("2024-03-02")): 1,
    }
    assert {r.score for r in rows} == {75.0}
    details = {r.entity_id: r.details for r in rows}
    assert details["1"] == "Duplicate invoice detected for vendor Vendor 1 within 30 days"
    assert details["5"] is None  # unknown name


def test_sub_threshold_repeats_need_three_small_claims(fact, names):
    df = fact(
        ("A", 9, 1, 4, "2023-11-06", 0.5), ("B", 8, 1, 4, "2023-11-06", 99), ("C", 9, 1, 2, "2023-11-12", 12.25),
        ("D", 2, 2, 2, "2024-01-18", 740),
        # 100 is no small claim; two small ones are not enough.
        ("E", 2, 2, 2, "2024-01-16", 100), ("F", 2, 2, 2, "2024-01-16", 99.99), ("G", 2, 2, 2, "2024-01-17", 1),
        # The first and last see two claims each, the middle one all three.
        ("H", 3, 3, 1, "2024-02-01", 5), ("I", 3, 3, 1, "2024-02-08", 5), ("J", 3, 3, 1, "2024-02-15", 5),
    )
    rows = rules.sub_threshold_repeats(df, names("employee_id", "employee_name", 1, 2, 3)).collect()
    assert sorted((r.entity_id, r.signal_date.isoformat(), r.score) for r in rows) == [
        ("1", "2023-11-06", 85.0), ("1", "2023-11-06", 85.0), ("1", "2023-11-12", 85.0),
        ("3", "2024-02-08", 85.0),
    ]
    assert {r.details for r in rows if r.entity_id == "1"} == {
        "Employee Employee 1 made 3 small claims in 7 days"
    }


def test_weekend_and_holiday_claims(spark, fact, names):
    calendar = calendar_between(spark, "2024-01-01", "2024-12-31", ["2024-01-01", "2024-01-06"])
    df = fact(
        ("A", 1, 1, 1, "2024-01-01", 1), ("B", 1, 1, 1, "2024-01-06", 1), ("C", 1, 1, 1, "2024-01-07", 1),
        ("D", 1, 1, 1, "2024-01-08", 1), ("E", 1, 1, 1, "2025-01-05", 1),
    )
    rows = rules.weekend_holiday_claims(df, calendar, names("employee_id", "employee_name", 1)).collect()
    assert sorted((r.signal_date.isoformat(), r.score, r.details) for r in rows) == [
        ("2024-01-01", 60.0, "Expense on holiday by Employee 1"),
        ("2024-01-06", 90.0, "Expense on weekend holiday by Employee 1"),
        ("2024-01-07", 70.0, "Expense on weekend by Employee 1"),
    ]


def test_unknown_calendar_flags_follow_three_valued_logic(spark, fact, names):
    calendar = spark.createDataFrame(
        [(day("2024-01-01"), None, True), (day("2024-01-02"), None, False), (day("2024-01-03"), True, None)],
        "date date, is_weekend boolean, is_holiday boolean",
    )
    df = fact(*[(f"A{i}", 1, 1, 1, f"2024-01-0{i}", 1) for i in (1, 2, 3)])
    rows = rules.weekend_holiday_claims(df, calendar, names("employee_id", "employee_name", 1)).collect()
    assert sorted((r.signal_date.day, r.score) for r in rows) == [(1, 60.0), (3, 70.0)]


def test_round_number_shares_at_the_boundaries(spark, fact, names):
    def department(dept, rounds, rows):
        return [(f"{dept}-{i}", 1, 1, dept, "2024-01-01", 500 if i < rounds else 501) for i in range(rows)]

    df = fact(*department(1, 2, 10), *department(2, 3, 10), *department(3, 1, 3), *department(4, 21, 100))
    out = rules.round_number_spikes(
        df, names("dept_id", "dept_name", 1, 2, 3, 4), as_of=F.lit("2024-06-01").cast("date")
    )
    rows = sorted((r.entity_id, r.score, r.signal_date, r.details) for r in out.collect())
    assert rows == [
        ("2", 45.0, day("2024-06-01"), "Department Dept 2 has 30.0% round number expenses in 2024-01"),
        ("3", 65.0, day("2024-06-01"), "Department Dept 3 has 33.3% round number expenses in 2024-01"),
        ("4", 45.0, day("2024-06-01"), "Department Dept 4 has 21.0% round number expenses in 2024-01"),
    ]
    today = rules.round_number_spikes(df, names("dept_id", "dept_name", 1)).select("signal_date", F.current_date())
    assert all(r[0] == r[1] for r in today.collect())


def test_campaign_spikes_at_the_boundaries(spark, names):
    def step(campaign, *values):
        return [
            (f"S{campaign}-{i}", campaign, date(2024, 1, 1) + timedelta(i), Decimal(str(c)), v)
            for i, (c, v) in enumerate(values)
        ]

    rows = [
        *step(1, (100, 100), (130, 110)),  # 30 % up, 10 % lift: 80
        *step(2, (100, 100), (120, 105)),  # 20 % up, 5 % lift: 60
        *step(3, (100, 100), (119, 100)),  # below the cost limit
        *step(4, (100, 100), (130, 111)),  # conversions follow
        *step(5, (100, 0), (200, 50)),  # no earlier conversions count as no lift
        *step(6, (100, None), (125, 50)),  # unknown earlier conversions too
        *step(7, (500, 10)),  # nothing to compare with
        *step(8, (100, 10), (130, None)),  # unknown lift is no signal
    ]
    df = spark.createDataFrame(
        rows, "spend_id string, campaign_id int, date date, cost decimal(10,2), conversions int"
    )
    out = rules.campaign_spend_spikes(df, names("campaign_id", "campaign_name", *range(1, 9))).collect()
    assert sorted((r.entity_id, r.score) for r in out) == [("1", 80.0), ("2", 60.0), ("5", 80.0), ("6", 60.0)]
    assert next(r.details for r in out if r.entity_id == "1").startswith(
        "Campaign Campaign 1 spend increased 30.0% with only 10.0"
    )


def test_signals_are_united_in_one_schema(fact, names):
    df = fact(("A", 1, 1, 1, "2024-01-15", 100), ("B", 1, 1, 1, "2024-01-20", 100))
    vendors = names("vendor_id", "vendor_name", 1)
    duplicates = rules.duplicate_invoices(df, vendors)
    rounds = rules.round_number_spikes(df, names("dept_id", "dept_name", 1))
    united = rules.leakage_signals(duplicates, rounds)
    assert united.columns == [*SIGNAL_COLUMNS, "created_timestamp"]
    assert Counter(r.rule_name for r in united.collect()) == {"duplicate_invoice": 2, "round_number_spikes": 1}


def matches_by_brute_force(rows, days, tolerance):
    out = {}
    for i, (invoice, vendor, when, amount) in enumerate(rows):
        out[invoice] = sum(
            1 for j, (_, other_vendor, other_day, other_amount) in enumerate(rows)
            if i != j and vendor == other_vendor and abs((when - other_day).days) <= days
            and abs(amount - other_amount) * 100 <= amount * tolerance
        )
    return out


@pytest.mark.parametrize(
    "days, tolerance, seed, rounds, chunk, cells",
    [(30, 10, 1, 48, 200_000, 12), (30, 10, 2, 1, 1, 12), (30, 10, 6, 2, 50, 1), (5, 50, 3, 1, 20, 3), (0, 1, 4, 48, 200_000, 12),
     (90, 95, 5, 3, 100, 2)],
)
def test_near_duplicates_equal_brute_force(spark, monkeypatch, days, tolerance, seed, rounds, chunk, cells):
    monkeypatch.setattr(near_duplicates, "ROUNDS", rounds)
    monkeypatch.setattr(near_duplicates, "CHUNK", chunk)
    monkeypatch.setattr(near_duplicates, "CELLS_IN_BLOCK", cells)
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        hot = rng.random() < 0.35  # one vendor and one price level hold a third of the rows
        vendor = 1 if hot else rng.randint(2, 12)
        amount = Decimal(rng.choice([9000, 10000, 11000, 9091, 9999])) if hot else Decimal(rng.randint(100, 30000))
        rows.append((f"I{i}", vendor, date(2024, 1, 1) + timedelta(rng.randint(0, 200)), amount / 100))
    # Exact copies, and pairs at the edges of both ranges.
    edge = date(2025, 1, 1)
    rows += [("c1", 20, edge, Decimal("5.00")), ("c2", 20, edge, Decimal("5.00"))]
    rows += [("e1", 21, edge, Decimal("100.00")), ("e2", 21, edge + timedelta(days), Decimal(100 + tolerance))]
    rows += [("f1", 22, edge, Decimal("100.00")), ("f2", 22, edge + timedelta(days + 1), Decimal("100.00"))]
    df = spark.createDataFrame(rows, "invoice_id string, vendor_id int, trx_date date, amount decimal(10,2)")
    points = {
        (r.vendor_id, r.trx_date, r.amount): min(2, r.matches)
        for r in near_duplicate_points(df, days, tolerance).collect()
    }
    expected = matches_by_brute_force(rows, days, tolerance)
    assert {i: points[v, d, a.quantize(Decimal("0.01"))] for i, v, d, a in rows} == {
        i: min(2, n) for i, n in expected.items()
    }


def test_a_crowded_day_sends_few_points(spark):
    """Of 5,000 amounts of one vendor and day, only the outermost of each cell are exchanged and compared; all are counted."""
    rows = spark.range(20_000).selectExpr(
        "concat('I', id) AS invoice_id", "1 AS vendor_id", "date_add(date'2024-01-01', cast(id % 4 as int)) AS trx_date",
        "cast(1000 + id / 100 as decimal(10,2)) AS amount")
    found = near_duplicate_points(rows, 30, 10)
    assert found.count() == 20_000 and found.agg({"matches": "min"}).first()[0] >= 2
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("RepartitionByExpression") == 1
    assert "Join" not in plan


def test_near_duplicate_signals(fact, names):
    df = fact(
        ("A", 1, 1, 1, "2024-01-15", 1000), ("B", 1, 1, 1, "2024-01-20", 1050),
        ("C", 2, 1, 1, "2024-01-15", 1000), ("D", 2, 1, 1, "2024-01-15", 1000), ("E", 2, 1, 1, "2024-02-01", 1010),
        ("F", 3, 1, 1, "2024-01-15", 1000), ("G", 3, 1, 1, "2024-01-15", 2000),
    )
    rows = rules.near_duplicate_invoices(df, names("vendor_id", "vendor_name", 1, 2, 3)).collect()
    assert Counter((r.entity_id, r.score) for r in rows) == {("1", 75.0): 2, ("2", 90.0): 3}
    with pytest.raises(ValueError):
        rules.near_duplicate_invoices(df, names("vendor_id", "vendor_name", 1), Thresholds(duplicate_tolerance_pct=0))
