from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Observation

from outlay.plans.stages import clean_csv
from outlay.sources.readers import MALFORMED, read_csv_text
from rows import day, expense
from outlay import schemas
from outlay.operators.cleaning import (
    EXPENSES, clean_budgets, clean_calendar, clean_campaign_spend, clean_expenses, judged, rejects,
)
from outlay.sources.readers import read_csv, read_csv_inferred
from outlay.sources.writers import write_csv


def test_schemas_have_the_declared_columns():
    assert [len(s) for s in (schemas.EXPENSES, schemas.BUDGETS, schemas.CAMPAIGN_SPEND, schemas.CALENDAR)] == [
        12, 5, 11, 7,
    ]


def test_valid_expenses_are_kept_and_stamped(expenses):
    clean = clean_expenses(expenses(
        expense("P-7", 31, 8, 4, "2023-06-30", 12.34), expense("P-8", 32, 9, 5, "2023-07-01", 0.01),
        expense("P-9", 31, 8, 4, "2020-02-29", 99999.99),
    ), "expenses.csv")
    assert clean.columns == [*schemas.EXPENSES.names, "ingestion_timestamp", "source_file"]
    rows = clean.collect()
    assert len(rows) == 3
    assert {r.source_file for r in rows} == {"expenses.csv"}
    assert all(r.ingestion_timestamp is not None for r in rows)


def test_invalid_expenses_are_dropped(expenses):
    clean = clean_expenses(expenses(
        expense(None, 6, 5, 4, "2023-05-09", 10), expense("A", 1, 1, 1, "2024-01-15", -0.01),
        expense("B", 1, 1, 1, "2024-01-15", 0), expense("C", 1, 1, 1, "2024-01-15", None),
        expense("D", 1, 1, 1, None, 10), expense("E", None, None, None, "2024-01-15", 10),
    ))
    assert [r.invoice_id for r in clean.collect()] == ["E"]


def test_one_expense_per_invoice_by_date_amount_vendor(expenses):
    clean = clean_expenses(expenses(
        expense("A", 1, 1, 1, "2024-01-16", 10), expense("A", 3, 1, 1, "2024-01-15", 30),
        expense("A", 2, 1, 1, "2024-01-15", 20), expense("A", 1, 1, 1, "2024-01-15", 20),
        expense("B", 1, 1, 1, "2024-01-15", 5),
    ))
    assert {r.invoice_id: (r.trx_date, r.amount, r.vendor_id) for r in clean.collect()} == {
        "A": (day("2024-01-15"), Decimal("20.00"), 1), "B": (day("2024-01-15"), Decimal("5.00"), 1),
    }


def test_budgets_need_a_department_and_an_amount(spark):
    rows = [
        (1, "Eng", "2024-01", Decimal("50000"), "USD"), (1, "Eng", "2024-01", Decimal("40000"), "USD"),
        (1, "Eng", None, Decimal("7"), "USD"), (None, "X", "2024-01", Decimal("1"), "USD"),
        (2, "Mkt", "2024-01", Decimal("0"), "USD"),
    ]
    clean = clean_budgets(spark.createDataFrame(rows, schemas.BUDGETS))
    assert {(r.dept_id, r.budget_month): r.budget_amount for r in clean.collect()} == {
        (1, "2024-01"): Decimal("40000.00"), (1, None): Decimal("7.00"),
    }


def test_campaign_spend_needs_id_date_and_cost(spark):
    def row(spend, when, cost):
        return (spend, 1, "C", "Web", "Sales", day(when) if when else None, Decimal(cost), 1, 2, 3, Decimal("4"))

    rows = [row("S1", "2024-01-02", "5"), row("S1", "2024-01-01", "6"), row(None, "2024-01-01", "5"),
            row("S2", None, "5"), row("S3", "2024-01-01", "0")]
    clean = clean_campaign_spend(spark.createDataFrame(rows, schemas.CAMPAIGN_SPEND))
    assert [(r.spend_id, r.date) for r in clean.collect()] == [("S1", day("2024-01-01"))]


def test_calendar_casts_text_and_keeps_one_row_per_date(spark):
    rows = [("2024-01-01", "1", "2024-01", "Q1", "2024", "False", "True"),
            ("2024-01-01", "1", "2024-01", "Q1", "2024", "True", "True"),
            ("not a date", "1", "2024-01", "Q1", "2024", "True", "True")]
    raw = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in schemas.CALENDAR.names))
    clean = clean_calendar(raw).drop("ingestion_timestamp", "source_file")
    assert [tuple(r) for r in clean.collect()] == [(date(2024, 1, 1), 1, "2024-01", "Q1", 2024, False, True)]


def test_csv_cells_that_do_not_parse_become_null(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        ",".join(schemas.EXPENSES.names) + "\n"
        "A,1,V,1,E,1,D,2024-01-15,10.006,USD,Wire,x\n"
        "B,one,V,1,E,1,D,2024-01-15,12.00,USD,Wire,x\n"
        "C,1,V,1,E,1,D,2024-13-45,12.00,USD,Wire,x\n"
        "D,1,V,1,E,1,D,2024-01-15,123456789012.00,USD,Wire,x\n"
    )
    raw = {r.invoice_id: r for r in read_csv(spark, str(path), schemas.EXPENSES).collect()}
    assert raw["A"].amount == Decimal("10.01")
    assert raw["B"].vendor_id is None and raw["C"].trx_date is None and raw["D"].amount is None
    clean = clean_expenses(read_csv(spark, str(path), schemas.EXPENSES), "raw.csv")
    assert sorted(r.invoice_id for r in clean.collect()) == ["A", "B"]


def test_rejected_rows_are_counted_by_their_first_reason(spark):
    raw = spark.createDataFrame([
        (None, "-5", "2024-01-01"), ("A", "12345678901.00", "2024-01-01"), ("B", "0", "2024-01-01"), ("C", None, "2024-01-01"),
        ("D", "1", "no date"), ("E", "1", None), ("F", "1", "2024-01-01"), ("F", "1", "2024-01-01"),
    ], "invoice_id string, amount string, trx_date string").selectExpr(
        "*", *[f"CAST(NULL AS STRING) AS {n}" for n in schemas.EXPENSES.names if n not in ("invoice_id", "amount", "trx_date")]
    )
    got = {r.reason: (r.table_name, r.row_count) for r in rejects(raw, EXPENSES, "t").collect()}
    assert got == {reason: ("t", 1) for reason in (
        "invoice_id missing", "amount does not fit", "amount not positive", "amount missing", "trx_date does not fit", "trx_date missing",
    )}
    seen = Observation()
    assert clean_expenses(raw, "t", seen).count() == 1
    assert {k: n for k, n in seen.get.items() if n} == {reason: 1 for reason in got}


def test_large_budgets_stay(spark):
    rows = [(1, "Eng", "2024-01", Decimal("9999999999.99"), "USD"), (2, "Mkt", "2024-01", Decimal("5000000000.00"), "USD")]
    assert clean_budgets(spark.createDataFrame(rows, schemas.BUDGETS)).count() == 2


def test_csv_round_trip(spark, expenses, tmp_path):
    df = expenses(expense("A", 1, 1, 1, "2024-01-15", 10), expense("B", 2, 2, 2, "2024-01-16", 20.5))
    write_csv(df, str(tmp_path / "out"))
    back = read_csv(spark, str(tmp_path / "out"), schemas.EXPENSES)
    assert sorted(back.collect()) == sorted(df.collect())
    inferred = dict(read_csv_inferred(spark, str(tmp_path / "out")).dtypes)
    assert inferred["vendor_id"] == "int" and inferred["amount"] == "double"


def test_every_row_is_accounted_for(spark, tmp_path):
    """Bad cells, short and long lines and duplicates: rejected + repaired or clean = all, and the lines are kept as they were."""
    lines = [
        "I1,1,V,1,E,1,D,2024-01-05,5.00,USD,Wire,ok", "I1,1,V,1,E,1,D,2024-01-05,5.00,USD,Wire,ok",
        "I2,x,V,1,E,1,D,2024-01-05,5.00,USD,Wire,vendor", "I3,1,V,1,E,1,D,soon,5.00,USD,Wire,date",
        "I4,1,V,1,E,1,D,2024-01-05,much,USD,Wire,amount", ",1,V,1,E,1,D,2024-01-05,5.00,USD,Wire,id",
        "I5,1,V,1,E,1,D,2024-01-05,5.00,USD", "I6,1,V,1,E,1,D,2024-01-05,5.00,USD,Wire,text,more", '"I7",1,"a, b",1,E,1,D,2024-01-05,0,USD,Wire,"zero"',
    ]
    path = tmp_path / "raw.csv"
    path.write_text("\n".join([",".join(schemas.EXPENSES.names), *lines]) + "\n")
    rows = judged(read_csv_text(spark, str(path), schemas.EXPENSES), EXPENSES, MALFORMED).collect()
    assert len(rows) == len(lines)
    found = {r.raw_line: (r.status, r.reason, r.unparsed) for r in rows if r.raw_line}
    assert found == {
        lines[2]: ("repaired", None, ["vendor_id"]), lines[3]: ("rejected", "trx_date does not fit", ["trx_date"]),
        lines[4]: ("rejected", "amount does not fit", ["amount"]), lines[5]: ("rejected", "invoice_id missing", []),
        lines[6]: ("repaired", None, []), lines[7]: ("repaired", None, []),
        'I7,1,"a, b",1,E,1,D,2024-01-05,0,USD,Wire,zero': ("rejected", "amount not positive", []),
    }
    total, aside = clean_csv(spark, str(path), str(tmp_path / "clean" / "t"), EXPENSES, clean_expenses, "t", "raw.csv")
    by_status = {r.status: r.n for r in aside.groupBy("status").agg({"row_count": "sum"}).toDF("status", "n").collect()}
    assert total == 4 and by_status == {"clean": 4, "duplicate": 1, "rejected": 4, "repaired": 3}
    assert by_status["clean"] + by_status["duplicate"] + by_status["rejected"] == len(lines)
    assert spark.read.parquet(str(tmp_path / "clean" / "t")).filter("invoice_id = 'I2'").first().vendor_id is None


def test_a_file_without_rows_is_clean(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(",".join(schemas.EXPENSES.names) + "\n")
    total, aside = clean_csv(spark, str(path), str(tmp_path / "clean" / "t"), EXPENSES, clean_expenses, "t", "raw.csv")
    assert total == 0 and {(r.status, r.row_count) for r in aside.collect()} == {("clean", 0), ("duplicate", 0)}
