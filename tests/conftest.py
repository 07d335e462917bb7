from __future__ import annotations

import os
import sys
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from outlay import schemas  # noqa: E402
from rows import day  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("outlay-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="outlay-warehouse-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def expenses(spark):
    def build(*rows):
        names = schemas.EXPENSES.names
        return spark.createDataFrame([[r[n] for n in names] for r in rows], schemas.EXPENSES)

    return build


FACT_SCHEMA = (
    "invoice_id string, vendor_id int, employee_id int, dept_id int, trx_date date, "
    "amount decimal(10,2), budget_month_key string"
)


@pytest.fixture
def fact(spark):
    """Fact rows (invoice, vendor, employee, dept, day, amount); the month is the day's."""

    def build(*rows):
        data = [
            (i, v, e, d, day(t) if t else None, Decimal(str(a)), t[:7] if t else None)
            for i, v, e, d, t, a in rows
        ]
        return spark.createDataFrame(data, FACT_SCHEMA)

    return build


@pytest.fixture
def names(spark):
    """A dimension (id, name) with the column names given."""

    def build(id_column, name_column, *ids):
        label = name_column.removesuffix("_name").capitalize()
        return spark.createDataFrame(
            [(i, f"{label} {i}") for i in ids], f"{id_column} int, {name_column} string"
        )

    return build
