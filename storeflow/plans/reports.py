"""The usual reports over the star schema.

Facts are summed by their own key before a dimension is joined.  The sums of a
hot product or customer are built in every task, and the join and the grouping
by name see one row per key instead of one per sale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeflow.functions.columns import money_label, pct_label
from storeflow.schemas import MONEY_SUM

_MINUTE = ["year", "month", "day", "hour", "minute"]


def revenue_by_minute(fact: DataFrame, time_dim: DataFrame) -> DataFrame:
    """Revenue and units per minute; newest hour first, minutes in order."""
    per_second = fact.groupBy("time_id").agg(
        F.sum("total_amount").alias("amount"), F.sum("quantity").alias("units")
    )
    return (
        per_second.join(time_dim, per_second["time_id"] == time_dim["id"])
        .groupBy(*_MINUTE)
        .agg(
            F.sum("amount").cast(MONEY_SUM).alias("total_revenue"),
            F.sum("units").cast("bigint").alias("total_quantity_sold"),
        )
        .orderBy(*[F.desc(c) for c in _MINUTE[:-1]], "minute")
    )


def _totals_by_name(
    fact: DataFrame, dim: DataFrame, key: str, name: str, measure: str, kind, out: str
) -> DataFrame:
    per_key = fact.groupBy(key).agg(F.sum(measure).alias("_sum"))
    return per_key.join(dim, key).groupBy(name).agg(F.sum("_sum").cast(kind).alias(out))


def _largest_first(totals: DataFrame, measure: str, name: str) -> DataFrame:
    return totals.orderBy(F.desc(measure), name)


def units_by_product(fact: DataFrame, product_dim: DataFrame) -> DataFrame:
    """Units sold per product name, best-selling first."""
    totals = _totals_by_name(
        fact, product_dim, "product_id", "product_name", "quantity", "bigint", "total_sold"
    )
    return _largest_first(totals, "total_sold", "product_name")


def top_products(fact: DataFrame, product_dim: DataFrame, n: int = 5) -> DataFrame:
    """The n best-selling product names."""
    return units_by_product(fact, product_dim).limit(n)


def revenue_by_product(fact: DataFrame, product_dim: DataFrame) -> DataFrame:
    """Revenue per product name, largest first."""
    totals = _totals_by_name(
        fact, product_dim, "product_id", "product_name", "total_amount", MONEY_SUM, "total_revenue"
    )
    return _largest_first(totals, "total_revenue", "product_name")


def spend_by_customer(fact: DataFrame, customer_dim: DataFrame) -> DataFrame:
    """Money spent per customer name, largest first."""
    totals = _totals_by_name(
        fact, customer_dim, "customer_id", "customer_name", "total_amount", MONEY_SUM, "total_spent"
    )
    return _largest_first(totals, "total_spent", "customer_name")


def share(totals: DataFrame, measure: str) -> DataFrame:
    """Add each row's percentage of the whole, as number and as label.

    The whole is one value computed on its own; no task sees all rows.
    """
    whole = totals.agg(F.sum(measure)).scalar()
    pct = F.round(F.try_divide(F.col(measure) * 100, whole), 1).cast("decimal(5,1)")
    return totals.withColumn("pct", pct).withColumn("pct_label", pct_label("pct"))


def with_money_label(totals: DataFrame, measure: str) -> DataFrame:
    """Add the measure as text with thousands separators."""
    return totals.withColumn("label", money_label(measure))
