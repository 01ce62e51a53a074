"""Checks on amounts, keys and references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeflow.schemas import MONEY_SUM


def line_amount_check(
    items: DataFrame, quantity: str = "quantity", price: str = "price", stated: str = "total_amount"
) -> DataFrame:
    """Add the amount a line should have and whether the stated one agrees."""
    expected = (F.col(quantity).cast("bigint") * F.col(price)).cast(MONEY_SUM)
    return items.withColumn("expected_amount", expected).withColumn(
        "amount_ok", F.col("expected_amount") == F.col(stated)
    )


def invoice_total_check(
    headers: DataFrame,
    items: DataFrame,
    key: str = "import_id",
    stated: str = "total_invoice_amount",
    amount: str = "total_amount",
) -> DataFrame:
    """Compare each header's total with the sum of its lines.

    Lines are summed before the join, so the join sees one row per invoice.
    """
    sums = items.groupBy(key).agg(F.sum(amount).cast(MONEY_SUM).alias("line_total"))
    return headers.select(key, stated).join(sums, key).withColumn(
        "total_ok", F.col(stated) == F.col("line_total")
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row, with the number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Key values of the child that the parent lacks, with the number of child rows.

    Null references are no violation.  Child rows are counted per key first, so a
    frequent key crosses the shuffle once per task.
    """
    used = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("lines"))
    return used.join(parent.select(key), key, "left_anti")


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, nulls) for each column, in one pass."""
    columns = columns or df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "nulls")
