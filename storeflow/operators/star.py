"""Star schema: dimension rows, insert-if-absent, fact rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeflow.functions.columns import calendar, line_key, time_key
from storeflow.plans.lineage import freeze
from storeflow.plans.skew import BROADCAST_ROWS

_CLOCK = ["date", "hour", "minute", "second"]


def _one_per_key(lines: DataFrame, key: str, name: str) -> DataFrame:
    """Distinct (key, name) pairs, then one name per key: the first in the alphabet.

    The first step removes the bulk in each task, whatever the key's share of rows.
    """
    pairs = lines.where(F.col(key).isNotNull()).select(key, name).distinct()
    return pairs.groupBy(key).agg(F.min(name).alias(name))


def product_rows(lines: DataFrame) -> DataFrame:
    return _one_per_key(lines, "product_id", "product_name")


def customer_rows(lines: DataFrame) -> DataFrame:
    return _one_per_key(lines, "customer_id", "customer_name")


def time_rows(lines: DataFrame, column: str = "timestamp") -> DataFrame:
    """One row per second that occurs in the lines."""
    seconds = (
        lines.where(F.col(column).isNotNull())
        .groupBy(time_key(column).alias("id"))
        .agg(F.min(column).alias("_at"))
    )
    return seconds.select("id", *calendar("_at"))


def new_dim_rows(rows: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows (one per key) whose key the dimension does not have yet.

    The rows are built once.  Of the dimension just the key column is scanned, between the smallest and
    largest key at hand, so files of other stretches (of time, say) are passed over by their statistics.  If the
    keys are few enough to go to every executor, a long dimension is not shuffled.
    """
    rows = freeze(rows)
    n, low, high = rows.agg(F.count(F.lit(1)), F.min(key), F.max(key)).first()
    if not n:
        return rows
    known = dim.select(key).where(F.col(key).between(F.lit(low), F.lit(high)))
    if n <= BROADCAST_ROWS:
        known = known.join(F.broadcast(rows.select(key)), key, "left_semi")
    return rows.join(known, key, "left_anti")


def lookup_time_id(lines: DataFrame, time_dim: DataFrame, column: str = "timestamp") -> DataFrame:
    """Add ``time_id`` from a time dimension with keys of its own.

    Joins on date and clock, one id per second even if the dimension repeats it.
    Times the dimension does not hold give null.
    """
    ids = time_dim.groupBy(*_CLOCK).agg(F.min("id").alias("time_id"))
    parts = {
        "date": F.to_date(column),
        "hour": F.hour(column),
        "minute": F.minute(column),
        "second": F.second(column),
    }
    return lines.withColumns(parts).join(ids, _CLOCK, "left").drop(*_CLOCK)


def sales_fact(lines: DataFrame, time_dim: DataFrame | None = None) -> DataFrame:
    """Fact rows of purchase lines.

    The time key follows from the line's own time and needs no lookup; pass a
    ``time_dim`` only if it numbers its rows otherwise.
    """
    if time_dim is None:
        lines = lines.withColumn("time_id", time_key("timestamp"))
    else:
        lines = lookup_time_id(lines, time_dim)
    return lines.select(
        "product_id",
        "customer_id",
        "time_id",
        line_key().alias("sale_id"),
        "quantity",
        F.col("price").alias("sale_prices"),
        F.col("total_price").alias("total_amount"),
    )


def max_time_key(time_dim: DataFrame) -> DataFrame:
    """Largest time key, as one row."""
    return time_dim.agg(F.max("id").alias("max_id"))
