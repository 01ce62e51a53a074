"""Wire schemas, stored tables and their keys.

Money is ``decimal(15,2)``.  Event times are timestamps without a zone, so the
same invoice gives the same time key whatever zone the session runs in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(15, 2)
MONEY_SUM = T.DecimalType(25, 2)

# Column that receives the text of a JSON document Spark could not parse.
CORRUPT = "_corrupt_record"


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_STR, _INT, _LONG, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.TimestampNTZType()

IMPORT_ITEM = _struct(product_id=_STR, product_name=_STR, quantity=_INT, price=MONEY, total_amount=MONEY)
IMPORT_INVOICE = _struct(
    import_id=_STR,
    delivery_hour=_STR,
    total_invoice_amount=MONEY,
    items=T.ArrayType(IMPORT_ITEM),
    # Where in a long order this document starts; may be missing.
    first_line=_INT,
)

PURCHASE_ITEM = _struct(product_id=_STR, product_name=_STR, quantity=_INT, price=MONEY, total_price=MONEY)
PURCHASE_INVOICE = _struct(
    customer_id=_STR,
    customer_name=_STR,
    purchased_items=T.ArrayType(PURCHASE_ITEM),
    total_invoice_amount=MONEY,
    timestamp=_STR,
    first_line=_INT,
)

TABLES: dict[str, T.StructType] = {
    "import_invoices": _struct(
        import_id=_STR, delivery_hour=_TS, total_invoice_amount=MONEY, timestamp_inserted=_TS
    ),
    "import_items": _struct(
        id=_STR, import_id=_STR, product_id=_STR, product_name=_STR,
        quantity=_INT, price=MONEY, total_amount=MONEY,
    ),
    "inventory": _struct(
        product_id=_STR, product_name=_STR, quantity=_LONG, sale_prices=MONEY,
        reorder_level=_INT, last_updated=_TS,
    ),
    "movements": _struct(
        product_id=_STR, product_name=_STR, event_time=_TS, source_id=_STR,
        line_no=_INT, quantity=_INT, price=MONEY, kind=_STR,
    ),
    "product_dim": _struct(product_id=_STR, product_name=_STR),
    "customer_dim": _struct(customer_id=_STR, customer_name=_STR),
    "time_dim": _struct(
        id=_LONG, date=T.DateType(), year=_INT, month=_INT, day=_INT,
        hour=_INT, minute=_INT, second=_INT, weekday=_INT,
    ),
    "sales_fact": _struct(
        product_id=_STR, customer_id=_STR, time_id=_LONG, sale_id=_STR,
        quantity=_INT, sale_prices=MONEY, total_amount=MONEY,
    ),
    # Of the products of a snapshot: where their first receipt stands among movements.
    "openings": _struct(
        product_id=_STR, untimed=T.BooleanType(), event_time=_TS, source_id=_STR, line_no=_INT
    ),
    # Requests the guard has granted, and how much of each product each batch of them took.
    "accepted_lines": _struct(
        source_id=_STR, line_no=_INT, customer_id=_STR, product_id=_STR, quantity=_INT, fulfilled=_LONG
    ),
    "reservations": _struct(product_id=_STR, reserved=_LONG),
    # Reservations of all batches up to one, added up.
    "reservation_totals": _struct(product_id=_STR, reserved=_LONG),
    # The facts again, in a folder per day, and which batches of each stream are among them.
    "sales_fact_by_day": _struct(
        product_id=_STR, customer_id=_STR, time_id=_LONG, sale_id=_STR,
        quantity=_INT, sale_prices=MONEY, total_amount=MONEY, day=T.DateType(),
    ),
    "layout_marks": _struct(stream=_STR, last_batch=_LONG),
    # Which batches of each stream a published stock snapshot covers.
    "snapshot_marks": _struct(stream=_STR, last_batch=_LONG),
    "rejects": _struct(source_id=_STR, payload=_STR, reason=_STR),
}

# Tables whose files lie in folders by a column, and the order of rows in a file.
LAYOUT: dict[str, tuple[str, str]] = {"sales_fact_by_day": ("day", "time_id")}

PRIMARY_KEYS: dict[str, list[str]] = {
    "import_invoices": ["import_id"],
    "import_items": ["id"],
    "inventory": ["product_id", "last_updated"],
    "movements": ["source_id", "line_no", "product_id"],
    "product_dim": ["product_id"],
    "customer_dim": ["customer_id"],
    "time_dim": ["id"],
    "sales_fact": ["product_id", "customer_id", "time_id", "sale_id"],
    "accepted_lines": ["source_id", "line_no"],
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("import_items", "import_id", "import_invoices", "import_id"),
    ("sales_fact", "product_id", "product_dim", "product_id"),
    ("sales_fact", "customer_id", "customer_dim", "customer_id"),
    ("sales_fact", "time_id", "time_dim", "id"),
]

# Columns a database fills from its own sequence.
SERIAL_COLUMNS: dict[str, list[str]] = {"import_items": ["id"], "sales_fact": ["sale_id"]}


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of the schema, in a form the optimizer can see is empty."""
    fields = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(1).select(*fields).where(F.lit(False))
