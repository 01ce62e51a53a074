"""What each stream does with one micro-batch.

Every output depends on the batch and on earlier batches only, so running a batch
again gives the same tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeflow.functions.columns import stamped, with_event_time
from storeflow.operators import inventory, invoices, star
from storeflow.sources.store import run_together
from storeflow.sources.reservations import reserved_before, write_totals

IMPORTS, SALES, STAR, GUARD, NOTICES = "imports", "sales", "star", "guard", "notices"
# Tables of a batch that are written at a time.
TABLES_AT_ONCE = 4
# Invoices that make a partition's rows worth files of their own.
FILE_INVOICES = 20_000


@contextmanager
def _kept(batch: DataFrame) -> Iterator[DataFrame]:
    """Parse the batch once for all the tables it feeds.  One that is kept already stays so."""
    if batch.is_cached:
        yield batch
        return
    batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield batch
    finally:
        batch.unpersist()


def _large(batch: DataFrame) -> bool:
    """Whether the partitions of a kept batch are large enough to be written as they are, without a shuffle.

    Fills what is kept, so tables written at a time do not wait for each other's parsing.
    """
    parts = batch.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    invoices, n = parts.agg(F.sum("n"), F.count(F.lit(1))).first()
    return n > 0 and invoices >= FILE_INVOICES * n


@contextmanager
def _batch(store, source: str, batch_id: int, batch: DataFrame) -> Iterator[Callable[[DataFrame, str], None]]:
    """What appends to the batch's tables.  They become visible together if the store can do that."""
    if hasattr(store, "batch"):
        with store.batch(source, batch_id) as writing:
            writing.gather = not _large(batch)
            yield writing.append
    else:
        yield lambda df, table: store.append(df, table, source=source, batch_id=batch_id)


def import_batch(batch: DataFrame, batch_id: int, store) -> None:
    """Import invoices into stock movements, headers, items and rejects."""
    with _kept(batch), _batch(store, IMPORTS, batch_id, batch) as add:
        lines = with_event_time(invoices.explode_imports(batch), "delivery_hour")
        headers = with_event_time(invoices.import_headers(batch), "delivery_hour")
        run_together(
            batch.sparkSession,
            TABLES_AT_ONCE,
            (add, inventory.receipts(lines), "movements"),
            (add, stamped(headers, "timestamp_inserted"), "import_invoices"),
            (add, invoices.import_items(lines), "import_items"),
            (add, invoices.import_rejects(batch), "rejects"),
        )


def sale_batch(batch: DataFrame, batch_id: int, store) -> None:
    """Purchase invoices into stock movements and rejects."""
    with _kept(batch), _batch(store, SALES, batch_id, batch) as add:
        lines = with_event_time(invoices.explode_purchases(batch), "timestamp")
        run_together(
            batch.sparkSession,
            TABLES_AT_ONCE,
            (add, inventory.withdrawals(lines), "movements"),
            (add, invoices.purchase_rejects(batch), "rejects"),
        )


def warehouse_batch(batch: DataFrame, batch_id: int, store) -> None:
    """Purchase invoices into the star schema: new dimension rows, and facts."""
    with _kept(batch), _batch(store, STAR, batch_id, batch) as add:
        lines = with_event_time(invoices.explode_purchases(batch), "timestamp")
        headers = with_event_time(invoices.purchase_headers(batch), "timestamp")

        def add_new(rows: DataFrame, table: str, key: str) -> None:
            earlier = store.read(table, before_batch=batch_id)
            add(star.new_dim_rows(rows, earlier, key), table)

        run_together(
            batch.sparkSession,
            TABLES_AT_ONCE,
            (add_new, star.product_rows(lines), "product_dim", "product_id"),
            (add_new, star.customer_rows(headers), "customer_dim", "customer_id"),
            (add_new, star.time_rows(headers), "time_dim", "id"),
            (add, star.sales_fact(lines), "sales_fact"),
        )


def guard_batch(batch: DataFrame, batch_id: int, store, stock: DataFrame) -> None:
    """Grant requests from stock, first come, first served over all batches so far.

    Requests of a batch stand behind those of earlier batches, and among themselves in the order of the log.
    What each batch grants is written per product; a batch reads no more of that than the last sum and what came
    after it, and of ``stock`` (product_id, quantity) no more than the guard does.
    """
    with _kept(batch), store.batch(GUARD, batch_id) as writing:
        writing.gather = not _large(batch)
        lines = invoices.explode_purchases(batch)
        requests = lines.select("source_id", "line_no", "customer_id", "product_id", "quantity")
        earlier = reserved_before(store, GUARD, batch_id)
        granted = inventory.oversell_guard(requests, stock, ["source_id", "line_no"], reserved=earlier)
        accepted = writing.append(granted.withColumn("fulfilled", F.col("fulfilled").cast("bigint")), "accepted_lines")
        taken = accepted.groupBy("product_id").agg(F.sum("fulfilled").alias("reserved"))
        writing.append(taken, "reservations")
    write_totals(store, GUARD, batch_id)


def purchase_batch(
    batch: DataFrame,
    batch_id: int,
    store,
    notify: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Purchase messages into stock, star schema and notices, read and parsed once.

    Each of the three has a commit mark of its own: a batch that failed after one of them runs just the others
    again.  ``notify`` writes a batch's notices; its mark is set afterwards, so it may run twice.
    """
    with _kept(invoices.parse_purchases(batch)) as parsed:
        todo = [(sale_batch, SALES), (warehouse_batch, STAR)]
        calls = [(write, parsed, batch_id, store) for write, source in todo if not store.finished(source, batch_id)]
        if notify and not store.finished(NOTICES, batch_id):
            calls.append((_notices, parsed, batch_id, store, notify))
        if calls:
            _large(parsed)  # Parses before outputs are written side by side.
            run_together(batch.sparkSession, len(calls), *calls)


def _notices(parsed: DataFrame, batch_id: int, store, notify: Callable[[DataFrame, int], None]) -> None:
    notify(invoices.keyed_notifications(invoices.explode_purchases(parsed)), batch_id)
    store.mark(NOTICES, batch_id)


def preview(df: DataFrame, n: int = 20) -> None:
    """Print some rows.  Runs the plan again, so no writer calls it by itself."""
    df.show(n)
