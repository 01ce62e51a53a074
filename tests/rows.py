"""Hand-made rows for the unit tests."""

from __future__ import annotations

import contextlib
import io
import json
from datetime import datetime, timedelta
from decimal import Decimal

T0 = datetime(2025, 3, 1, 9, 0, 0)


def money(text) -> Decimal:
    return Decimal(text).quantize(Decimal("0.01"))


def at(seconds: int) -> datetime:
    return T0 + timedelta(seconds=seconds)


def item(product, quantity, price, name=None, total=None, amount="total_amount") -> dict:
    return {
        "product_id": product,
        "product_name": name or f"name {product}",
        "quantity": quantity,
        "price": price,
        amount: total if total is not None else quantity * price,
    }


def import_doc(import_id, items, seconds=0, total=None) -> str:
    return json.dumps(
        {
            "import_id": import_id,
            "delivery_hour": str(at(seconds)),
            "total_invoice_amount": total if total is not None else sum(i["total_amount"] for i in items),
            "items": items,
        }
    )


def purchase_doc(customer, items, seconds=0, name=None) -> str:
    return json.dumps(
        {
            "customer_id": customer,
            "customer_name": name or f"customer {customer}",
            "purchased_items": items,
            "total_invoice_amount": sum(i["total_price"] for i in items),
            "timestamp": str(at(seconds)),
        }
    )


def sold(product, quantity, price, name=None) -> dict:
    return item(product, quantity, price, name, amount="total_price")


def messages(spark, docs, start=0):
    """Documents as rows of a message log."""
    rows = [("purchases", 0, start + i, doc.encode()) for i, doc in enumerate(docs)]
    return spark.createDataFrame(rows, "topic string, partition int, offset bigint, value binary")


MOVEMENT = (
    "product_id string, product_name string, event_time timestamp_ntz, source_id string, "
    "line_no int, quantity int, price decimal(15,2), kind string"
)
STOCK = (
    "product_id string, product_name string, quantity bigint, sale_prices decimal(15,2), "
    "reorder_level int"
)


def movements(spark, rows):
    """(product, seconds, source, line, signed quantity, price) tuples as movements."""
    full = [
        (p, f"name {p}", at(s), src, n, q, money(c), "receipt" if q > 0 else "sale") for p, s, src, n, q, c in rows
    ]
    return spark.createDataFrame(full, MOVEMENT)


def rows_of(df, *columns) -> set:
    chosen = df.select(*columns) if columns else df
    return {tuple(r) for r in chosen.collect()}


def plan_of(df, mode="formatted") -> str:
    """What ``explain`` prints."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()
