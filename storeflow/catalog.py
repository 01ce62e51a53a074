"""Every registered query: ``fn(spark, folder)`` over a folder of sample tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from storeflow.functions.columns import with_event_time
from storeflow.operators import audit, inventory, invoices, star
from storeflow.plans import reports
from storeflow.plans.feeds import Feed
from storeflow.plans.lineage import freeze, fresh_folder
from storeflow.plans.views import LINE_ORDER, Retail
from storeflow.schemas import IMPORT_INVOICE, MONEY, TABLES, empty
from storeflow.sources.store import ParquetStore
from storeflow.sources.streams import read_archived_imports, read_import_stream, read_imports
from storeflow.streaming.batches import STAR
from storeflow.streaming.jobs import (
    start_guard,
    start_imports,
    start_purchases,
    start_purchases_together,
    write_notifications,
)
from storeflow.warehouse import Warehouse

# Receipts before this day make the opening stock of the merge queries.
OPENING_DAY = "1998-01-01"
DRAIN = {"availableNow": True}

_LINE = ["product_id", "product_name", "quantity", "price"]


# Reports

def revenue_by_minute(spark: SparkSession, folder: str) -> DataFrame:
    till = Retail(spark, folder).till()
    return reports.revenue_by_minute(star.sales_fact(till), star.time_rows(till))


def revenue_by_minute_weekend(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue per minute of Saturdays and Sundays, from facts in folders by day."""
    till = Retail(spark, folder).till()
    facts = star.sales_fact(till).withColumns({c: F.col(c).cast("string") for c in ("product_id", "customer_id")})
    store = _new_store(spark)
    with store.batch(STAR, 0) as writing:
        writing.append(facts, "sales_fact")
        writing.append(star.time_rows(till), "time_dim")
    warehouse = Warehouse(store)
    warehouse.lay_out_facts(0)
    return warehouse.revenue_by_minute_of(F.col("weekday").isin(1, 7))


def units_by_product(spark: SparkSession, folder: str) -> DataFrame:
    r = Retail(spark, folder)
    return reports.units_by_product(r.product_sales(), r.products())


def top5_products(spark: SparkSession, folder: str) -> DataFrame:
    r = Retail(spark, folder)
    return reports.top_products(r.product_sales(), r.products(), 5)


def revenue_by_product(spark: SparkSession, folder: str) -> DataFrame:
    r = Retail(spark, folder)
    return reports.revenue_by_product(r.product_sales(), r.products())


def spend_by_customer(spark: SparkSession, folder: str) -> DataFrame:
    r = Retail(spark, folder)
    return reports.spend_by_customer(r.customer_sales(), r.customers())


def revenue_share(spark: SparkSession, folder: str) -> DataFrame:
    return reports.share(revenue_by_product(spark, folder), "total_revenue")


def spend_share(spark: SparkSession, folder: str) -> DataFrame:
    return reports.share(spend_by_customer(spark, folder), "total_spent")


def spend_labels(spark: SparkSession, folder: str) -> DataFrame:
    return reports.with_money_label(spend_by_customer(spark, folder), "total_spent")


# Star schema

def product_dim(spark: SparkSession, folder: str) -> DataFrame:
    r = Retail(spark, folder)
    # Names live in the part table, so ids are made distinct before the join.
    ids = r.sold().select("product_id").distinct()
    return star.product_rows(ids.join(r.products(), "product_id"))


def customer_dim(spark: SparkSession, folder: str) -> DataFrame:
    r = Retail(spark, folder)
    ids = r.sold_orders().select("customer_id").distinct()
    return star.customer_rows(ids.join(r.customers(), "customer_id"))


def time_dim(spark: SparkSession, folder: str) -> DataFrame:
    return star.time_rows(Retail(spark, folder).till())


def max_time_key(spark: SparkSession, folder: str) -> DataFrame:
    return star.max_time_key(time_dim(spark, folder))


def sales_fact(spark: SparkSession, folder: str) -> DataFrame:
    return star.sales_fact(Retail(spark, folder).till()).drop("sale_id")


def sales_fact_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Facts whose time key is looked up in the time dimension."""
    till = Retail(spark, folder).till()
    return star.sales_fact(till, star.time_rows(till)).drop("sale_id")


def new_products(spark: SparkSession, folder: str) -> DataFrame:
    """Products of the sold lines that the till has not sold yet."""
    known = Retail(spark, folder).till().select("product_id").distinct()
    return star.new_dim_rows(product_dim(spark, folder), known, "product_id")


def new_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with orders whom the till has not seen yet."""
    known = Retail(spark, folder).till().select("customer_id").distinct()
    return star.new_dim_rows(customer_dim(spark, folder), known, "customer_id")


# Stock

def _no_stock(spark: SparkSession) -> DataFrame:
    stock = empty(spark, TABLES["inventory"]).drop("last_updated")
    return stock.withColumn("product_id", F.col("product_id").cast("bigint"))


def _opening_stock(r: Retail) -> DataFrame:
    early = r.received().where(F.col("event_time") < F.lit(OPENING_DAY).cast("timestamp_ntz"))
    return inventory.restock(_no_stock(r.spark), early, LINE_ORDER)


def current_inventory(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.current_inventory(Retail(spark, folder).inventory_log(), ties="one")


def current_inventory_ties(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.current_inventory(Retail(spark, folder).inventory_log(), ties="keep")


def restock_from_empty(spark: SparkSession, folder: str) -> DataFrame:
    r = Retail(spark, folder)
    stock = inventory.restock(_no_stock(spark), r.received(), LINE_ORDER)
    return inventory.named(stock, r.products())


def restock_merge(spark: SparkSession, folder: str) -> DataFrame:
    r = Retail(spark, folder)
    late = r.received().where(F.col("event_time") >= F.lit(OPENING_DAY).cast("timestamp_ntz"))
    return inventory.named(inventory.restock(_opening_stock(r), late, LINE_ORDER), r.products())


def sale_decrement(spark: SparkSession, folder: str) -> DataFrame:
    r = Retail(spark, folder)
    return inventory.named(inventory.sell(_opening_stock(r), r.sold(), LINE_ORDER), r.products())


def stock_on_hand(spark: SparkSession, folder: str) -> DataFrame:
    r = Retail(spark, folder)
    return inventory.named(inventory.stock_on_hand(r.movements(), LINE_ORDER), r.products())


def stock_roll_forward(spark: SparkSession, folder: str) -> DataFrame:
    """The same stock, from a snapshot at the opening day and what came after."""
    r = Retail(spark, folder)
    early = F.col("event_time") < F.lit(OPENING_DAY).cast("timestamp_ntz")
    snapshot = inventory.stock_on_hand(r.movements().where(early), LINE_ORDER)
    later = inventory.roll_forward(snapshot, r.movements().where(~early), LINE_ORDER)
    return inventory.named(later, r.products())


def stock_reorder_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Stock rolled forward from the opening day, with reorder levels by part size."""
    r = Retail(spark, folder)
    levels = r.table("part").select(
        F.col("p_partkey").alias("product_id"), (F.col("p_size") * 2).cast("int").alias("reorder_level")
    )
    early = F.col("event_time") < F.lit(OPENING_DAY).cast("timestamp_ntz")
    snapshot = inventory.stock_on_hand(r.movements().where(early), LINE_ORDER)
    later = inventory.roll_forward(
        snapshot, r.movements().where(~early), LINE_ORDER, reorder_levels=levels
    )
    return inventory.named(later, r.products())


def low_stock(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.low_stock(stock_on_hand(spark, folder))


def oversell_guard(spark: SparkSession, folder: str) -> DataFrame:
    """Sold lines served in order from the opening stock."""
    r = Retail(spark, folder)
    return inventory.oversell_guard(r.sold(), _opening_stock(r), LINE_ORDER)


# Invoices and messages

def import_items(spark: SparkSession, folder: str) -> DataFrame:
    """Nested import invoices through JSON files and back to typed lines."""
    path = fresh_folder(spark, "imports")
    Retail(spark, folder).import_documents().write.json(path)
    lines = with_event_time(invoices.explode_imports(read_imports(spark, path)), "delivery_hour")
    return lines.select("import_id", "line_no", "delivery_hour", *_LINE, "total_amount")


def import_invoices(spark: SparkSession, folder: str) -> DataFrame:
    lines = invoices.explode_imports(Retail(spark, folder).import_documents())
    return invoices.import_invoices(with_event_time(lines, "delivery_hour"))


def import_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Import invoices without a line: orders of which nothing has been received."""
    r = Retail(spark, folder)
    orders = r.table("orders").select(F.col("o_orderkey").cast("string").alias("import_id"))
    delivered = r.received().select(F.col("source_id").cast("string").alias("import_id")).distinct()
    documents = orders.join(delivered, "import_id", "left_anti").withColumn(
        "items", F.lit(None).cast(IMPORT_INVOICE["items"].dataType)
    )
    rejected = invoices.rejects(documents, "items", "import_id", IMPORT_INVOICE)
    return rejected.select("source_id", "reason")


def purchase_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Messages that give no line: orders without items, and texts that are no invoice."""
    messages = Retail(spark, folder).dirty_messages()
    return invoices.purchase_rejects(invoices.parse_purchases(messages))


def _purchase_lines(spark: SparkSession, folder: str) -> DataFrame:
    messages = Retail(spark, folder).purchase_messages()
    return invoices.explode_purchases(invoices.parse_purchases(messages))


def purchase_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Message bytes to typed sold lines."""
    lines = with_event_time(_purchase_lines(spark, folder), "timestamp")
    return lines.select(
        "customer_id", "customer_name", "total_invoice_amount", "timestamp", "line_no", *_LINE, "total_price"
    )


def notifications(spark: SparkSession, folder: str) -> DataFrame:
    return invoices.notifications(_purchase_lines(spark, folder))


def purchase_messages(spark: SparkSession, folder: str) -> DataFrame:
    documents = Retail(spark, folder).purchase_documents().drop("partition", "offset")
    return invoices.to_messages(documents, "customer_id")


# Audits

def line_amounts(spark: SparkSession, folder: str) -> DataFrame:
    """Stated line amounts against quantity times the part's retail price."""
    r = Retail(spark, folder)
    prices = r.table("part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_retailprice").cast(MONEY).alias("price")
    )
    lines = r.table("lineitem").select(
        F.col("l_orderkey").alias("import_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("total_amount"),
    )
    return audit.line_amount_check(lines.join(prices, "product_id"))


def invoice_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Order totals against the lines received for them."""
    r = Retail(spark, folder)
    headers = r.table("orders").select(
        F.col("o_orderkey").alias("import_id"),
        F.col("o_totalprice").cast(MONEY).alias("total_invoice_amount"),
    )
    items = r.received().select(
        F.col("source_id").alias("import_id"), F.col("price").alias("total_amount")
    )
    return audit.invoice_total_check(headers, items)


def pk_violations(spark: SparkSession, folder: str) -> DataFrame:
    lines = Retail(spark, folder).table("lineitem")
    return audit.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


def fk_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Received products missing from a product dimension that only the till has filled."""
    r = Retail(spark, folder)
    known = r.till().select("product_id").distinct()
    return audit.orphans(r.received(), known, "product_id")


def null_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Nulls per column of the product rows as the till's dimension would name them."""
    r = Retail(spark, folder)
    till = r.till()
    named = till.select("product_id").distinct().join(r.products(), "product_id")
    received = r.received().select("product_id").distinct()
    rows = received.join(named, "product_id", "left").join(
        till.groupBy("product_id").agg(F.max("timestamp").alias("last_sold")), "product_id", "left"
    )
    return audit.null_counts(rows, ["product_id", "product_name", "last_sold"])


# Streams: documents arrive as files in waves, are drained batch by batch, and the tables are read back.

def _import_feed(r: Retail) -> Feed:
    return Feed(r.import_documents(), "json", ["delivery_hour", "import_id", "first_line"], "import-feed")


def _message_feed(r: Retail, dirty: bool = False) -> Feed:
    messages = r.dirty_messages() if dirty else r.purchase_messages()
    return Feed(messages, "parquet", ["topic", "partition", "offset"], "purchase-feed")


def _import_job(feed: Feed, store: ParquetStore, clean: str = "off") -> list[StreamingQuery]:
    stream = read_import_stream(
        store.spark, feed.inbox, clean=clean, archive_dir=feed.archive if clean == "archive" else None,
        max_bytes=feed.batch_bytes,
    )
    return [start_imports(stream, store, feed.checkpoint, DRAIN, name=None)]


def _messages(feed: Feed, spark: SparkSession) -> DataFrame:
    reader = spark.readStream.schema(feed.schema).option("maxBytesPerTrigger", feed.batch_bytes)
    return reader.parquet(feed.inbox)


def _purchase_job(feed: Feed, store: ParquetStore) -> list[StreamingQuery]:
    """Stock and star schema from one reading of the log."""
    messages = _messages(feed, store.spark)
    return [start_purchases_together(messages, store, feed.checkpoint, trigger=DRAIN, name=None)]


def _star_job(feed: Feed, store: ParquetStore) -> list[StreamingQuery]:
    messages = _messages(feed, store.spark)
    return start_purchases(messages, store, feed.checkpoint, trigger=DRAIN, names=(None, None, None))


Job = tuple[Feed, Callable[[], list[StreamingQuery]]]


def _drain(*jobs: Job) -> None:
    """Wave by wave: publish, run every job on what is there, and start it again from its checkpoint."""
    while any([feed.publish() for feed, _ in jobs]):
        for query in [query for _, start in jobs for query in start()]:
            query.awaitTermination()


def _new_store(spark: SparkSession) -> ParquetStore:
    return ParquetStore(spark, fresh_folder(spark, "store")).create()


def _imported(spark: SparkSession, folder: str, clean: str = "off") -> tuple[ParquetStore, Feed]:
    store, feed = _new_store(spark), _import_feed(Retail(spark, folder))
    _drain((feed, partial(_import_job, feed, store, clean)))
    return store, feed


def _purchased(spark: SparkSession, folder: str, job=_purchase_job, dirty: bool = False) -> ParquetStore:
    store, feed = _new_store(spark), _message_feed(Retail(spark, folder), dirty)
    _drain((feed, partial(job, feed, store)))
    return store


def stream_import_items(spark: SparkSession, folder: str) -> DataFrame:
    store, _ = _imported(spark, folder)
    return store.read("import_items").select("import_id", *_LINE, "total_amount")


def stream_import_invoices(spark: SparkSession, folder: str) -> DataFrame:
    store, _ = _imported(spark, folder)
    return store.read("import_invoices").drop("timestamp_inserted")


def stream_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Import lines read again from what the stream has archived and what still lies in its inbox."""
    _, feed = _imported(spark, folder, clean="archive")
    invoices_again = read_archived_imports(spark, feed.inbox, feed.archive)
    lines = with_event_time(invoices.explode_imports(invoices_again), "delivery_hour")
    return lines.select("import_id", "line_no", "delivery_hour", *_LINE, "total_amount")


def stream_sales_fact(spark: SparkSession, folder: str) -> DataFrame:
    return _purchased(spark, folder, _star_job).read("sales_fact").drop("sale_id")


def stream_star_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Spend per customer, read from the facts and dimension the stream has loaded."""
    store = _purchased(spark, folder)
    return reports.spend_by_customer(store.read("sales_fact"), store.read("customer_dim"))


def stream_revenue_by_minute(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue per minute, read from the facts and times the stream has loaded."""
    store = _purchased(spark, folder)
    return reports.revenue_by_minute(store.read("sales_fact"), store.read("time_dim"))


def stream_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """What the purchase stream puts aside of a log with empty and unreadable messages."""
    return _purchased(spark, folder, dirty=True).read("rejects")


def _both(spark: SparkSession, folder: str) -> ParquetStore:
    r, store = Retail(spark, folder), _new_store(spark)
    goods, sales = _import_feed(r), _message_feed(r)
    _drain((goods, partial(_import_job, goods, store)), (sales, partial(_purchase_job, sales, store)))
    return store


def stream_stock(spark: SparkSession, folder: str) -> DataFrame:
    """Stock after both streams have written their movements."""
    return inventory.stock_on_hand(_both(spark, folder).read("movements"))


def stream_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """The same stock, read from the inventory log after a snapshot was published."""
    warehouse = Warehouse(_both(spark, folder))
    warehouse.publish_stock(0, streams_stopped=True)
    return warehouse.current_inventory().drop("last_updated")


def stream_inventory_late(spark: SparkSession, folder: str) -> DataFrame:
    """The same stock although snapshots come before the goods, and between their waves."""
    r, store = Retail(spark, folder), _new_store(spark)
    warehouse, sales, goods = Warehouse(store), _message_feed(r), _import_feed(r)
    _drain((sales, partial(_purchase_job, sales, store)))
    warehouse.publish_stock(0, streams_stopped=True)
    # The wave with the later deliveries first: products are then opened again from their history.
    goods.newest_first()
    snapshot = 0
    while goods.publish():
        for query in _import_job(goods, store):
            query.awaitTermination()
        snapshot += 1
        warehouse.publish_stock(snapshot, streams_stopped=True)
    return warehouse.current_inventory().drop("last_updated")


def stream_oversell(spark: SparkSession, folder: str) -> DataFrame:
    """Sold lines granted from the opening stock in the order of the log, batch after batch."""
    r, store = Retail(spark, folder), _new_store(spark)
    stock = freeze(_opening_stock(r).select(F.col("product_id").cast("string").alias("product_id"), "quantity"))
    feed = _message_feed(r)
    _drain((feed, lambda: [start_guard(_messages(feed, spark), store, stock, feed.checkpoint, DRAIN, name=None)]))
    return store.read("accepted_lines")


def stream_notifications(spark: SparkSession, folder: str) -> DataFrame:
    feed = _message_feed(Retail(spark, folder))
    sink = {"path": feed.out}
    _drain(
        (
            feed,
            lambda: [
                write_notifications(_messages(feed, spark), feed.checkpoint, "parquet", sink, DRAIN, name=None)
            ],
        )
    )
    return spark.read.schema("value string").parquet(feed.out)


QUERIES = {
    fn.__name__: fn
    for fn in (
        revenue_by_minute, revenue_by_minute_weekend, units_by_product, top5_products, revenue_by_product,
        spend_by_customer, revenue_share, spend_share, spend_labels,
        product_dim, customer_dim, time_dim, max_time_key, sales_fact, sales_fact_lookup,
        new_products, new_customers,
        current_inventory, current_inventory_ties, restock_from_empty, restock_merge,
        sale_decrement, stock_on_hand, stock_roll_forward, stock_reorder_levels, low_stock, oversell_guard,
        import_items, import_invoices, import_rejects, purchase_lines, notifications,
        purchase_messages, purchase_rejects,
        line_amounts, invoice_totals, pk_violations, fk_orphans, null_violations,
        stream_import_items, stream_import_invoices, stream_sales_fact, stream_star_reports,
        stream_revenue_by_minute, stream_rejects,
        stream_stock, stream_inventory, stream_inventory_late, stream_notifications,
        stream_oversell, stream_archive,
    )
}
