"""The two streaming jobs: goods imports, and purchases with their three outputs."""

from __future__ import annotations

import time
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from storeflow.operators.invoices import explode_purchases, keyed_notifications, parse_purchases
from storeflow.streaming.batches import (
    guard_batch,
    import_batch,
    purchase_batch,
    sale_batch,
    warehouse_batch,
)

# Every how long the import job looks for files.
IMPORT_TRIGGER = {"processingTime": "30 seconds"}


def _prepared(
    df: DataFrame, name: str | None, checkpoint: str, trigger: dict | None
) -> DataStreamWriter:
    writer = df.writeStream.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(**trigger) if trigger else writer


def start_imports(
    invoices: DataFrame,
    store,
    checkpoint: str,
    trigger: dict | None = IMPORT_TRIGGER,
    name: str | None = "imports",
) -> StreamingQuery:
    """Load a stream of import invoices into the store."""
    writer = _prepared(invoices, name, checkpoint, trigger)
    return writer.foreachBatch(partial(import_batch, store=store)).start()


def write_notifications(
    messages: DataFrame,
    checkpoint: str,
    sink: str,
    options: dict[str, str],
    trigger: dict | None = None,
    name: str | None = "notifications",
) -> StreamingQuery:
    """Publish one keyed JSON record per sold line.  ``sink`` is ``kafka`` in production.

    A batch that runs again may publish a record again, with the same key.
    """
    records = keyed_notifications(explode_purchases(parse_purchases(messages)))
    writer = _prepared(records, name, checkpoint, trigger)
    return writer.format(sink).options(**options).outputMode("append").start()


def start_purchases(
    messages: DataFrame,
    store,
    checkpoint: str,
    notify: tuple[str, dict[str, str]] | None = None,
    trigger: dict | None = None,
    names: tuple[str | None, str | None, str | None] = ("stock", "star", "notifications"),
) -> list[StreamingQuery]:
    """Feed purchases to stock, star schema and, if ``notify`` = (sink, options), to a topic.

    Three queries with checkpoints of their own below ``checkpoint``: each reads the
    source at its own pace and can be restarted alone.
    """
    invoices = parse_purchases(messages)
    root = checkpoint.rstrip("/")
    queries = [
        _prepared(invoices, name, f"{root}/{folder}", trigger)
        .foreachBatch(partial(write, store=store))
        .start()
        for name, folder, write in zip(names, ("stock", "star"), (sale_batch, warehouse_batch))
    ]
    if notify:
        sink, options = notify
        queries.append(
            write_notifications(messages, f"{root}/notifications", sink, options, trigger, names[2])
        )
    return queries


def _write_notices(records: DataFrame, batch_id: int, sink: str, options: dict[str, str]) -> None:
    """A batch's notices: files go below ``path``, a folder per batch, and replace an earlier attempt's."""
    if "path" in options:
        options = options | {"path": f"{options['path'].rstrip('/')}/batch_id={batch_id}"}
    mode = "overwrite" if "path" in options else "append"
    records.write.format(sink).options(**options).mode(mode).save()


def start_purchases_together(
    messages: DataFrame,
    store,
    checkpoint: str,
    notify: tuple[str, dict[str, str]] | None = None,
    trigger: dict | None = None,
    name: str | None = "purchases",
) -> StreamingQuery:
    """Feed purchases to stock, star schema and notices from one reading of the source.

    Where :func:`start_purchases` reads and parses the log once per output, so that each goes at its own pace, here each
    message is parsed once; every output still has its own commit mark.  Needs a store that keeps such marks.
    """
    write = partial(_write_notices, sink=notify[0], options=notify[1]) if notify else None
    writer = _prepared(messages, name, f"{checkpoint.rstrip('/')}/purchases", trigger)
    return writer.foreachBatch(partial(purchase_batch, store=store, notify=write)).start()


def start_guard(
    messages: DataFrame,
    store,
    stock: DataFrame,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = "guard",
) -> StreamingQuery:
    """Grant purchase requests from ``stock`` (product_id, quantity) as they come; see ``guard_batch``."""
    writer = _prepared(parse_purchases(messages), name, f"{checkpoint.rstrip('/')}/guard", trigger)
    return writer.foreachBatch(partial(guard_batch, store=store, stock=stock)).start()


def await_any(spark: SparkSession) -> None:
    """Block until one query ends, and raise if it failed."""
    spark.streams.awaitAnyTermination()


def stop_gracefully(queries: list[StreamingQuery], patience: float = 60.0) -> None:
    """Stop each query once its running batch is done, or when patience ends."""
    deadline = time.monotonic() + patience
    for query in queries:
        while query.isActive and query.status["isTriggerActive"] and time.monotonic() < deadline:
            time.sleep(0.1)
        query.stop()
