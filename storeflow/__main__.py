"""Command line: run the streaming jobs and print reports.

    python -m storeflow imports   --store S --checkpoint C --input DIR
    python -m storeflow purchases --store S --checkpoint C --servers H --topic T [--notify T2]
    python -m storeflow snapshot  --store S --id N
    python -m storeflow report    --store S NAME [--rows N]

Start it with ``spark-submit`` to choose master, memory and packages.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from storeflow.sources.store import ParquetStore
from storeflow.sources.streams import read_import_stream, read_purchase_stream, topic_sink
from storeflow.streaming.jobs import IMPORT_TRIGGER, await_any, start_imports, start_purchases
from storeflow.warehouse import Warehouse

REPORTS = (
    "revenue_by_minute", "units_by_product", "top_products", "revenue_by_product",
    "spend_by_customer", "revenue_share", "spend_share", "stock", "low_stock", "current_inventory",
)


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser("storeflow", description="Stock and sales from nested invoices")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, streams: bool = False) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.add_argument("--store", required=True, help="folder of the tables")
        if streams:
            sub.add_argument("--checkpoint", required=True, help="folder of the stream's progress")
            sub.add_argument("--once", action="store_true", help="take what is there, then end")
        return sub

    imports = command("imports", streams=True)
    imports.add_argument("--input", required=True, help="folder watched for invoices")
    imports.add_argument("--max-files", type=int, default=1)
    imports.add_argument("--clean", choices=("delete", "archive", "off"), default="delete")
    imports.add_argument("--archive-dir")

    purchases = command("purchases", streams=True)
    purchases.add_argument("--servers", required=True)
    purchases.add_argument("--topic", required=True)
    purchases.add_argument("--notify", help="topic for one message per sold line")
    purchases.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")

    snapshot = command("snapshot")
    snapshot.add_argument("--id", type=int, required=True, help="higher than the last one")
    snapshot.add_argument("--streams-stopped", action="store_true")
    report = command("report")
    report.add_argument("name", choices=REPORTS)
    report.add_argument("--rows", type=int, default=20)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = SparkSession.builder.appName(f"storeflow {args.command}").getOrCreate()
    store = ParquetStore(spark, args.store)
    once = {"availableNow": True}
    if args.command == "imports":
        stream = read_import_stream(spark, args.input, args.max_files, args.clean, args.archive_dir)
        trigger = once if args.once else IMPORT_TRIGGER
        start_imports(stream, store.create(), args.checkpoint, trigger).awaitTermination()
    elif args.command == "purchases":
        options = dict(o.split("=", 1) for o in args.option)
        stream = read_purchase_stream(spark, args.servers, args.topic, options)
        notify = ("kafka", topic_sink(args.servers, args.notify)) if args.notify else None
        trigger = once if args.once else None
        queries = start_purchases(stream, store.create(), args.checkpoint, notify, trigger)
        if args.once:
            for query in queries:
                query.awaitTermination()
        else:
            await_any(spark)
    elif args.command == "snapshot":
        Warehouse(store).publish_stock(args.id, args.streams_stopped)
    else:
        getattr(Warehouse(store), args.name)().show(args.rows, truncate=False)


if __name__ == "__main__":
    main()
