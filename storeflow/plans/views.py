"""The retail data model as views over the sample tables.

Shipped lines (status F) play goods received, open lines (status O) goods sold,
purchase events the till.  ``lineitem`` holds line amounts and no unit prices, so
the amount stands for the price as well.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storeflow.functions.columns import second_of
from storeflow.plans.skew import no_key_above, profile_keys, running_before
from storeflow.schemas import MONEY

# Lines of one order that go into one document; a longer order becomes several.
DOCUMENT_LINES = 10_000

# (order, line number) repeats in the sample lines, so ties go on to the amounts.
LINE_ORDER = ["event_time", "source_id", "line_no", "quantity", "price"]


def _money(column: str) -> Column:
    return F.col(column).cast(MONEY)


@dataclass(frozen=True)
class Retail:
    """Views over one folder of sample tables."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _lines(self, status: str) -> DataFrame:
        return self.table("lineitem").where(F.col("l_linestatus") == status).select(
            F.col("l_orderkey").alias("source_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_shipdate").alias("event_time"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            _money("l_extendedprice").alias("price"),
        )

    def received(self) -> DataFrame:
        """Goods received, one row per line."""
        return self._lines("F")

    def sold(self) -> DataFrame:
        """Goods sold, one row per line; ``event_time`` is the day of shipping."""
        return self._lines("O")

    def product_sales(self) -> DataFrame:
        """Fact columns of the sold lines, as far as product reports read them."""
        return self.sold().select("product_id", "quantity", F.col("price").alias("total_amount"))

    def customer_sales(self) -> DataFrame:
        """Fact columns of the sold lines with their customer."""
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("source_id"), F.col("o_custkey").alias("customer_id")
        )
        # Amounts are added up per order first: the join then sees an order once.
        amounts = self.sold().groupBy("source_id").agg(F.sum("price").alias("total_amount"))
        return amounts.join(orders, "source_id").select("customer_id", "total_amount")

    def sold_orders(self) -> DataFrame:
        """Orders with at least one sold line."""
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("source_id"), F.col("o_custkey").alias("customer_id")
        )
        return orders.join(self.sold().select("source_id").distinct(), "source_id", "left_semi")

    def movements(self) -> DataFrame:
        """Receipts and sales as signed movements on the day of shipping."""
        lines = self.table("lineitem").where(F.col("l_linestatus").isin("F", "O"))
        units = F.col("l_quantity").cast("int")
        return lines.select(
            F.col("l_partkey").alias("product_id"),
            F.col("l_shipdate").alias("event_time"),
            F.col("l_orderkey").alias("source_id"),
            F.col("l_linenumber").alias("line_no"),
            F.when(F.col("l_linestatus") == "F", units).otherwise(-units).alias("quantity"),
            _money("l_extendedprice").alias("price"),
        )

    def inventory_log(self) -> DataFrame:
        """Every line read as a stock snapshot of its product."""
        return self.table("lineitem").select(
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            _money("l_extendedprice").alias("sale_prices"),
            F.col("l_shipdate").alias("last_updated"),
        )

    def till(self) -> DataFrame:
        """Purchase events as sold lines with a time of day."""
        units = F.get_json_object("props", "$.k")
        return self.table("events").where(F.col("event_type") == "purchase").select(
            F.col("event_id").alias("source_id"),
            F.lit(0).alias("line_no"),
            F.col("user_id").alias("customer_id"),
            second_of("ts").alias("timestamp"),
            units.cast("bigint").alias("product_id"),
            units.cast("int").alias("quantity"),
            _money("value").alias("price"),
            _money("value").alias("total_price"),
        )

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name")
        )

    def customers(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name")
        )

    def _documents(self, lines: DataFrame, amount: str, document_lines: int | None) -> DataFrame:
        """Lines nested per order: (source_id, part, first_line, shipped, total, items).

        An order above ``document_lines`` lines is delivered in several documents, so no array
        grows with the data.  They share the order's id, time and total; ``first_line`` says where
        in the order a document starts (null: at its beginning), so lines are numbered alike at any size.
        """
        most = document_lines or DOCUMENT_LINES
        received = lines
        place = ["line_no", "product_id", "quantity", "price", "product_name"]
        lines = lines.join(self.products(), "product_id")
        document = ["source_id", "part"]
        shipped, total, item = F.max("event_time"), F.sum("price"), F.collect_list(F.struct(*place))
        if no_key_above(received, "source_id", most):
            sc = self.spark.sparkContext
            files = max(sc.defaultParallelism, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
            # A window sorts an order's lines once; an aggregate would build each array twice.
            order = Window.partitionBy("source_id").orderBy(*place)
            every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            nested = lines.repartition(files, "source_id").select(
                "source_id",
                F.lit(0).alias("part"),
                shipped.over(every).alias("shipped"),
                total.over(every).cast(MONEY).alias("total"),
                item.over(every).alias("items"),
                F.row_number().over(order).alias("_line"),
            )
            nested = nested.where("_line = 1").drop("_line")
        else:
            profile = profile_keys(received, "source_id")
            numbered = running_before(lines.withColumn("_one", F.lit(1)), "_one", place, profile, "_place")
            part = (F.col("_place") / most).cast("int").alias("part")
            parts = numbered.select("source_id", part, *place).groupBy(*document)
            parts = parts.agg(F.sort_array(item).alias("items"))
            # A row per order meets a row per document: neither side has hot keys of any weight.
            whole = lines.groupBy("source_id").agg(shipped.alias("shipped"), total.cast(MONEY).alias("total"))
            nested = parts.join(whole, "source_id")
        return nested.withColumn("first_line", F.nullif(F.col("part") * most, F.lit(0))).withColumn(
            "items",
            F.transform(
                "items",
                lambda i: F.struct(
                    i["product_id"].cast("string").alias("product_id"),
                    i["product_name"].alias("product_name"),
                    i["quantity"].alias("quantity"),
                    i["price"].alias("price"),
                    i["price"].alias(amount),
                ),
            ),
        )

    def import_documents(self, document_lines: int | None = None) -> DataFrame:
        """Goods received as nested import invoices."""
        return self._documents(self.received(), "total_amount", document_lines).select(
            F.col("source_id").cast("string").alias("import_id"),
            F.col("shipped").cast("string").alias("delivery_hour"),
            F.col("total").alias("total_invoice_amount"),
            "items",
            "first_line",
        )

    def purchase_documents(self, document_lines: int | None = None) -> DataFrame:
        """Goods sold as nested purchase invoices, with their place in a topic."""
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("source_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("string").alias("timestamp"),
        )
        # Customers join the orders, so that documents, the wider rows, are not moved for them.
        return (
            self._documents(self.sold(), "total_price", document_lines)
            .join(orders.join(self.customers(), "customer_id"), "source_id")
            .select(
                F.col("part").alias("partition"),
                F.col("source_id").alias("offset"),
                F.col("customer_id").cast("string").alias("customer_id"),
                "customer_name",
                F.col("items").alias("purchased_items"),
                F.col("total").alias("total_invoice_amount"),
                "timestamp",
                "first_line",
            )
        )

    def purchase_messages(self) -> DataFrame:
        """Purchase invoices as rows of a message log."""
        documents = self.purchase_documents()
        fields = [c for c in documents.columns if c not in ("partition", "offset")]
        return documents.select(
            F.lit("purchases").alias("topic"),
            "partition",
            "offset",
            F.col("customer_id").cast("binary").alias("key"),
            F.to_json(F.struct(*fields)).cast("binary").alias("value"),
        )

    def dirty_messages(self) -> DataFrame:
        """The same log as it arrives: orders of which nothing is sold come without items, and
        texts that are no invoice stand between them (on a topic of their own, so places stay unique)."""
        bare = (
            self.table("orders")
            .select(
                F.col("o_orderkey").alias("offset"),
                F.col("o_custkey").cast("string").alias("customer_id"),
                F.col("o_orderdate").cast("string").alias("timestamp"),
            )
            .join(self.sold().select(F.col("source_id").alias("offset")), "offset", "left_anti")
        )
        fields = F.struct("customer_id", F.array().cast("array<string>").alias("purchased_items"), "timestamp")
        without_items = bare.select(
            F.lit("purchases").alias("topic"),
            F.lit(0).alias("partition"),
            "offset",
            F.col("customer_id").cast("binary").alias("key"),
            F.to_json(fields).cast("binary").alias("value"),
        )
        texts = self.table("documents").select(
            F.lit("texts").alias("topic"),
            F.lit(0).alias("partition"),
            F.col("doc_id").alias("offset"),
            F.lit(None).cast("binary").alias("key"),
            F.col("text").cast("binary").alias("value"),
        )
        return self.purchase_messages().unionByName(without_items).unionByName(texts)
