"""Row builders that the tests share; the name is no conftest's, so another folder's conftest cannot shadow it."""

from __future__ import annotations

from datetime import date
from decimal import Decimal


def day(text: str) -> date:
    return date.fromisoformat(text)


def expense(invoice, vendor, employee, dept, when, amount, month=None, **more):
    return {
        "invoice_id": invoice, "vendor_id": vendor, "vendor_name": f"Vendor {vendor}",
        "employee_id": employee, "employee_name": f"Employee {employee}",
        "dept_id": dept, "dept_name": f"Dept {dept}",
        "trx_date": day(when) if when else None,
        "amount": Decimal(str(amount)) if amount is not None else None,
        "currency": "USD", "payment_method": "Wire", "description": "text", **more,
    }


def as_dicts(df):
    return [r.asDict() for r in df.collect()]
