"""Nested invoices to typed lines, and lines back to messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from storeflow.functions.columns import line_key
from storeflow.schemas import CORRUPT, IMPORT_INVOICE, MONEY, PURCHASE_INVOICE

_MESSAGE_POSITION = ("topic", "partition", "offset")


def message_id(columns: list[str]) -> Column:
    """Identity of a message: its place in the log, else a hash of its bytes.

    Offsets are zero-padded, so the text sorts the way the log does.
    """
    if all(c in columns for c in _MESSAGE_POSITION):
        return F.concat_ws(
            "-",
            "topic",
            F.lpad(F.col("partition").cast("string"), 6, "0"),
            F.lpad(F.col("offset").cast("string"), 19, "0"),
        )
    return F.sha2("value", 256)


def _first_line(invoices: DataFrame) -> Column:
    """Number of a document's first line: 0 unless it continues an order."""
    return F.coalesce("first_line", F.lit(0)) if "first_line" in invoices.columns else F.lit(0)


def _without_lines(items: str) -> Column:
    return F.col(items).isNull() | (F.size(items) == 0)


def parse_purchases(messages: DataFrame) -> DataFrame:
    """Decode a ``value`` column of JSON bytes into purchase invoices.

    A message that is no JSON keeps its row with null fields.  ``payload`` is the text
    of messages that give no line, for :func:`purchase_rejects`; others need not carry it.
    """
    text = F.col("value").cast("string")
    parsed = messages.select(
        message_id(messages.columns).alias("source_id"),
        text.alias("payload"),
        F.from_json(text, PURCHASE_INVOICE).alias("invoice"),
    ).select("source_id", "payload", "invoice.*")
    return parsed.withColumn("payload", F.when(_without_lines("purchased_items"), F.col("payload")))


def purchase_headers(invoices: DataFrame) -> DataFrame:
    """Customer and time of the purchase invoices that have lines, one row each."""
    return invoices.where(~_without_lines("purchased_items")).select(
        "source_id", "customer_id", "customer_name", "total_invoice_amount", "timestamp"
    )


def explode_purchases(invoices: DataFrame) -> DataFrame:
    """One row per purchased item.  Invoices without items give no row.

    The outer form, with its empty rows taken out afterwards: the plain one would
    test the array in a filter below the parser and so decode each message again.
    """
    lines = invoices.select(
        "source_id",
        "customer_id",
        "customer_name",
        "total_invoice_amount",
        "timestamp",
        _first_line(invoices).alias("_first"),
        F.posexplode_outer("purchased_items").alias("line_no", "item"),
    ).where("line_no IS NOT NULL")
    return lines.select(
        "source_id", (F.col("_first") + F.col("line_no")).alias("line_no"), "customer_id", "customer_name", "total_invoice_amount", "timestamp",
        "item.product_id", "item.product_name", "item.quantity", "item.price", "item.total_price",
    )


def explode_imports(invoices: DataFrame) -> DataFrame:
    """One row per delivered item.  Invoices without items give no row."""
    lines = invoices.select(
        "import_id",
        "delivery_hour",
        "total_invoice_amount",
        _first_line(invoices).alias("_first"),
        F.posexplode("items").alias("line_no", "item"),
    )
    return lines.select(
        "import_id",
        (F.col("_first") + F.col("line_no")).alias("line_no"),
        "delivery_hour",
        "total_invoice_amount",
        "item.product_id",
        "item.product_name",
        F.col("item.quantity").try_cast("int").alias("quantity"),
        F.col("item.price").try_cast(MONEY).alias("price"),
        F.col("item.total_amount").try_cast(MONEY).alias("total_amount"),
    )


def import_invoices(lines: DataFrame) -> DataFrame:
    """Invoice headers: exploded lines folded back to one row per invoice."""
    return lines.select("import_id", "delivery_hour", "total_invoice_amount").distinct()


def import_headers(invoices: DataFrame) -> DataFrame:
    """Headers of the import invoices that have lines, one row each, without exploding them.

    Of an order in several documents the first gives the header.
    """
    first = invoices.where(~_without_lines("items") & (_first_line(invoices) == 0))
    return first.select("import_id", "delivery_hour", "total_invoice_amount").distinct()


def import_items(lines: DataFrame) -> DataFrame:
    """Rows of the items table.  The id is the invoice and the place in it."""
    return lines.select(
        F.concat_ws("-", "import_id", "line_no").alias("id"),
        "import_id", "product_id", "product_name", "quantity", "price", "total_amount",
    )


def rejects(
    invoices: DataFrame, items: str, source_id: str, wire: StructType, payload: str | None = None
) -> DataFrame:
    """Invoices that yield no line, with the reason and what they held.

    ``wire`` is their schema; ``payload`` names a column with the raw text, if any.
    """
    fields = [F.col(f) for f in wire.fieldNames() if f in invoices.columns]
    unreadable = F.coalesce(*[f.cast("string") for f in fields]).isNull()
    held = F.to_json(F.struct(*fields))
    return invoices.where(_without_lines(items)).select(
        F.col(source_id).alias("source_id"),
        (F.coalesce(payload, held) if payload else held).alias("payload"),
        F.when(unreadable, "unreadable").otherwise("no items").alias("reason"),
    )


def import_rejects(invoices: DataFrame) -> DataFrame:
    return rejects(invoices, "items", "import_id", IMPORT_INVOICE, CORRUPT)


def purchase_rejects(invoices: DataFrame) -> DataFrame:
    return rejects(invoices, "purchased_items", "source_id", PURCHASE_INVOICE, "payload")


def notifications(lines: DataFrame, *more: str) -> DataFrame:
    """One JSON text per sold line, with ``more`` columns as they are.  The time stays the text that arrived."""
    return lines.select(
        *more,
        F.to_json(
            F.struct(
                "customer_id", "customer_name", "total_invoice_amount", "timestamp",
                "product_id", "product_name", "quantity", "price", "total_price",
            )
        ).alias("value")
    )


def keyed_notifications(lines: DataFrame) -> DataFrame:
    """Notifications with a ``key``: a notice that is sent twice carries the same one, so a reader can drop repeats."""
    keyed = lines.withColumn("key", line_key())
    return notifications(keyed, "key")


def to_messages(df: DataFrame, key: str) -> DataFrame:
    """Rows as keyed JSON messages; the key spreads them over the topic's partitions."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*df.columns)).alias("value"),
    )
