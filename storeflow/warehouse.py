"""A store seen as the retail warehouse: its tables, its stock, its reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeflow.functions.columns import day_of, stamped
from storeflow.operators import audit, inventory
from storeflow.plans import reports
from storeflow.plans.lineage import freeze
from storeflow.schemas import FOREIGN_KEYS, PRIMARY_KEYS, TABLES
from storeflow.sources.store import LAYOUTS, SNAPSHOTS


class Warehouse:
    """Everything a report reader needs; each method returns a DataFrame."""

    def __init__(self, store):
        self.store = store

    def table(self, name: str) -> DataFrame:
        return self.store.read(name)

    def register(self) -> None:
        """Make every table a temporary view, for reports written in SQL."""
        for name in TABLES:
            self.table(name).createOrReplaceTempView(name)

    def stock(self, reorder_levels: DataFrame | None = None) -> DataFrame:
        """Stock on hand from all movements."""
        return inventory.stock_on_hand(self.table("movements"), reorder_levels=reorder_levels)

    def low_stock(self, reorder_levels: DataFrame | None = None) -> DataFrame:
        return inventory.low_stock(self.stock(reorder_levels))

    def publish_stock(
        self, snapshot_id: int, streams_stopped: bool = False, reorder_levels: DataFrame | None = None
    ) -> None:
        """Append today's stock to the inventory log.

        Starts from the last snapshot and adds the batches that came since; of the history it
        reads no more than the movements of products new to the snapshot.  The newest batch of each stream may still be
        in writing and waits for the next snapshot, unless the streams have stopped.
        The result equals :meth:`stock` over the same batches, in whatever order movements arrive: openings of
        products are published with the stock, and a receipt dated before one reopens just that product.
        Needs a :class:`~storeflow.sources.store.ParquetStore`, whose rows know their batch.
        """
        store = self.store
        last, covered = store.last_snapshot(before=snapshot_id)
        wait = 0 if streams_stopped else 1
        moves = store.parts("movements")
        newest = store.newest_batches("movements")
        upto = covered | {stream: batch - wait for stream, batch in newest.items()}
        seen = [p for p in moves if p.rows and p.batch_id <= upto[p.source]]
        history = store.rows_of(seen, "movements").drop("source", "batch_id")
        if last is None:
            stock = inventory.stock_on_hand(history, reorder_levels=reorder_levels, with_opening=True)
        else:
            fresh = [p for p in seen if p.batch_id > covered.get(p.source, -1)]
            tail = store.rows_of(fresh, "movements").drop("source", "batch_id")
            before = store.rows_of(store.snapshot_parts("inventory", last), "inventory")
            opened = store.rows_of(store.snapshot_parts("openings", last), "openings")
            opened = opened.select("product_id", F.struct(*inventory.opening_order()).alias("opening"))
            stock = inventory.roll_forward(
                before, tail, history=history, reorder_levels=reorder_levels, openings=opened
            )
        stock = freeze(stock)
        marks = stock.sparkSession.createDataFrame(list(upto.items()), TABLES["snapshot_marks"])
        with store.batch(SNAPSHOTS, snapshot_id) as writing:
            writing.append(stamped(stock, "last_updated"), "inventory")
            writing.append(stock.select("product_id", "opening.*"), "openings")
            writing.append(marks, "snapshot_marks")

    def lay_out_facts(self, layout_id: int) -> None:
        """Add the finished batches of facts that came since the last layout to the facts by day.

        Meant for a nightly run: a batch touches many days, so the streams themselves write no folder per day.
        """
        store = self.store
        covered = store.laid_out()
        parts = [p for p in store.parts("sales_fact") if p.batch_id > covered.get(p.source, -1)]
        newest: dict[str, int] = {}
        for p in parts:
            newest[p.source] = max(p.batch_id, newest.get(p.source, p.batch_id))
        rows = store.rows_of([p for p in parts if p.rows], "sales_fact").withColumn("day", day_of("time_id"))
        marks = rows.sparkSession.createDataFrame(list(newest.items()), TABLES["layout_marks"])
        with store.batch(LAYOUTS, layout_id) as writing:
            writing.append(rows, "sales_fact_by_day")
            writing.append(marks, "layout_marks")

    def facts_of(self, times: DataFrame) -> DataFrame:
        """Facts of the days that rows of the time dimension lie in.

        Of the facts by day only the folders of those days are read: which, turns out when the query runs
        (dynamic partition pruning).  Batches not laid out yet are read whole.
        """
        store = self.store
        covered = store.laid_out()
        fresh = [p for p in store.parts("sales_fact") if p.rows and p.batch_id > covered.get(p.source, -1)]
        tail = store.rows_of(fresh, "sales_fact").withColumn("day", day_of("time_id"))
        days = times.select(F.col("date").alias("day")).distinct()
        return self.table("sales_fact_by_day").unionByName(tail.drop("source", "batch_id")).join(days, "day").drop("day")

    def revenue_by_minute_of(self, which: Column) -> DataFrame:
        """Revenue per minute over those times that ``which``, a condition on the time dimension, picks."""
        times = self.table("time_dim").where(which)
        return reports.revenue_by_minute(self.facts_of(times), times)

    def current_inventory(self, ties: str = "keep") -> DataFrame:
        """Newest row per product of the inventory log.

        A snapshot holds every product, so of those just the newest is read.
        """
        return inventory.current_inventory(self._newest_inventory(), ties)

    def _newest_inventory(self) -> DataFrame:
        store = self.store
        if not hasattr(store, "parts"):
            return self.table("inventory")
        last, _ = store.last_snapshot()
        parts = [p for p in store.parts("inventory") if p.source != SNAPSHOTS or p.batch_id == last]
        return store.rows_of(parts, "inventory").drop("source", "batch_id")

    def revenue_by_minute(self) -> DataFrame:
        return reports.revenue_by_minute(self.table("sales_fact"), self.table("time_dim"))

    def units_by_product(self) -> DataFrame:
        return reports.units_by_product(self.table("sales_fact"), self.table("product_dim"))

    def top_products(self, n: int = 5) -> DataFrame:
        return reports.top_products(self.table("sales_fact"), self.table("product_dim"), n)

    def revenue_by_product(self) -> DataFrame:
        return reports.revenue_by_product(self.table("sales_fact"), self.table("product_dim"))

    def spend_by_customer(self) -> DataFrame:
        return reports.spend_by_customer(self.table("sales_fact"), self.table("customer_dim"))

    def revenue_share(self) -> DataFrame:
        return reports.share(self.revenue_by_product(), "total_revenue")

    def spend_share(self) -> DataFrame:
        return reports.share(self.spend_by_customer(), "total_spent")

    def key_violations(self) -> dict[str, DataFrame]:
        return {t: audit.duplicate_keys(self.table(t), k) for t, k in PRIMARY_KEYS.items()}

    def reference_violations(self) -> dict[str, DataFrame]:
        found = {}
        for child, column, parent, key in FOREIGN_KEYS:
            known = self.table(parent).withColumnRenamed(key, column)
            found[f"{child}.{column}"] = audit.orphans(self.table(child), known, column)
        return found

    def null_violations(self) -> dict[str, DataFrame]:
        return {t: audit.null_counts(self.table(t)) for t in TABLES}
