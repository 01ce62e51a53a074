import json
import time

import pytest
from pyspark.sql import functions as F

from rows import at, import_doc, item, messages, money, movements, purchase_doc, rows_of, sold
from storeflow.__main__ import main
from storeflow.operators.inventory import stock_on_hand
from storeflow.sources import streams
from storeflow.sources.store import ParquetStore
from storeflow.streaming import batches, jobs
from storeflow.operators.invoices import parse_purchases
from storeflow.warehouse import Warehouse

DRAIN = {"availableNow": True}


@pytest.fixture
def store(spark, tmp_path):
    return ParquetStore(spark, str(tmp_path / "store"))


def drop_files(folder, docs):
    folder.mkdir(exist_ok=True)
    for name, doc in docs.items():
        (folder / f"{name}.json").write_text(doc + "\n")
        time.sleep(0.01)


def log_stream(spark, folder, batches_of_docs):
    """A message log as files: one file per batch."""
    start = 0
    for docs in batches_of_docs:
        batch = messages(spark, docs, start)
        batch.coalesce(1).write.mode("append").parquet(str(folder))
        start += len(docs)
    return spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def drain_imports(spark, store, tmp_path, **options):
    stream = streams.read_import_stream(spark, str(tmp_path / "in"), **options)
    query = jobs.start_imports(stream, store, str(tmp_path / "cp"), DRAIN, name=None)
    query.awaitTermination()
    return query


def test_import_stream(spark, store, tmp_path):
    drop_files(tmp_path / "in", {
        "0": import_doc("I0", [item("A1", 5, 10), item("A2", 2, 7.5)]),
        "1": "not json",
        "2": import_doc("I2", [item("A1", 1, 99)], 60),
        "3": import_doc("I3", []),
    })
    drain_imports(spark, store, tmp_path, clean="off")
    assert rows_of(store.read("import_invoices").drop("timestamp_inserted")) == {
        ("I0", at(0), money(65)), ("I2", at(60), money(99))
    }
    assert rows_of(store.read("import_items"), "id", "product_id", "quantity", "price") == {
        ("I0-0", "A1", 5, money(10)), ("I0-1", "A2", 2, money("7.5")), ("I2-0", "A1", 1, money(99))
    }
    assert rows_of(store.read("rejects"), "source_id", "reason") == {
        (None, "unreadable"), ("I3", "no items")
    }
    # One file per trigger: the table has a partition per file.
    written = {f.split("batch_id=")[1].split("/")[0] for f in store.read("import_items").inputFiles()}
    assert written == {"0", "1", "2", "3"}
    assert rows_of(stock_on_hand(store.read("movements")), "product_id", "quantity", "sale_prices") == {
        ("A1", 6, money(12)), ("A2", 2, money(9))
    }


def test_import_stream_goes_on_where_it_stopped(spark, store, tmp_path):
    drop_files(tmp_path / "in", {"0": import_doc("I0", [item("A", 1, 1)])})
    drain_imports(spark, store, tmp_path, clean="off")
    drop_files(tmp_path / "in", {"1": import_doc("I1", [item("A", 2, 1)])})
    drain_imports(spark, store, tmp_path, clean="off")
    assert rows_of(store.read("import_items"), "id") == {("I0-0",), ("I1-0",)}


def test_consumed_files_are_archived(spark, store, tmp_path):
    docs = {str(i): import_doc(f"I{i}", [item("A", 1, 1)]) for i in range(4)}
    drop_files(tmp_path / "in", docs)
    drain_imports(spark, store, tmp_path, clean="archive", archive_dir=str(tmp_path / "kept"))
    kept = list((tmp_path / "kept").rglob("*.json"))
    left = list((tmp_path / "in").glob("*.json"))
    # Files are moved after a later batch has started, the last ones not at all.
    assert kept and len(kept) + len(left) == 4
    assert store.read("import_items").count() == 4


def test_consumed_files_are_deleted(spark, store, tmp_path):
    docs = {str(i): import_doc(f"I{i}", [item("A", 1, 1)]) for i in range(4)}
    drop_files(tmp_path / "in", docs)
    drain_imports(spark, store, tmp_path)
    assert len(list((tmp_path / "in").glob("*.json"))) < 4
    assert store.read("import_items").count() == 4


def test_archive_needs_a_folder(spark):
    with pytest.raises(ValueError):
        streams.read_import_stream(spark, "/tmp/x", clean="archive")


def test_purchase_stream_fills_stock_star_and_topic(spark, store, tmp_path):
    first = [
        purchase_doc("C1", [sold("A", 2, 3), sold("B", 1, 5)], 0),
        purchase_doc("C2", [sold("A", 1, 3), sold("A", 4, 3)], 30),
        "not json",
    ]
    second = [
        purchase_doc("C1", [sold("A", 1, 3)], 30, name="renamed"),
        purchase_doc("C3", [sold("D", 1, 1)], 90),
        purchase_doc("C4", []),
    ]
    stream = log_stream(spark, tmp_path / "log", [first, second])
    out = str(tmp_path / "out")
    started = jobs.start_purchases(
        stream, store, str(tmp_path / "cp"), ("json", {"path": out}), DRAIN, ("a", "b", "c")
    )
    assert [q.name for q in started] == ["a", "b", "c"]
    for query in started:
        query.awaitTermination()

    fact = store.read("sales_fact")
    assert fact.count() == 6
    assert rows_of(fact, "customer_id", "product_id", "quantity") == {
        ("C1", "A", 2), ("C1", "B", 1), ("C2", "A", 1), ("C2", "A", 4), ("C1", "A", 1), ("C3", "D", 1)
    }
    assert rows_of(store.read("customer_dim")) == {
        ("C1", "customer C1"), ("C2", "customer C2"), ("C3", "customer C3")
    }
    assert rows_of(store.read("product_dim"), "product_id") == {("A",), ("B",), ("D",)}
    # A second met again in a later batch stays one row.
    assert store.read("time_dim").count() == 3
    assert rows_of(store.read("rejects"), "reason") == {("unreadable",), ("no items",)}
    assert store.read("movements").agg(F.sum("quantity")).collect()[0][0] == -10
    notes = spark.read.json(out)
    assert notes.count() == 6
    note = json.loads(notes.where(F.col("value").contains('"D"')).collect()[0]["value"])
    assert note["timestamp"] == str(at(90)) and note["quantity"] == 1

    wh = Warehouse(store)
    assert [tuple(r) for r in wh.units_by_product().collect()] == [("name A", 8), ("name B", 1), ("name D", 1)]
    assert [tuple(r) for r in wh.top_products(1).collect()] == [("name A", 8)]
    assert [r["customer_name"] for r in wh.spend_by_customer().collect()] == [
        "customer C2", "customer C1", "customer C3"
    ]
    assert [r["total_revenue"] for r in wh.revenue_by_minute().collect()] == [money(29), money(1)]
    assert {r["pct_label"] for r in wh.revenue_share().collect()} == {"80.0%", "16.7%", "3.3%"}
    assert wh.spend_share().count() == 3
    assert all(v.count() == 0 for v in wh.key_violations().values())
    assert all(v.count() == 0 for v in wh.reference_violations().values())
    wh.register()
    by_sql = spark.sql(
        "SELECT p.product_name, SUM(s.quantity) AS total_sold FROM sales_fact s "
        "JOIN product_dim p ON s.product_id = p.product_id GROUP BY p.product_name "
        "ORDER BY total_sold DESC"
    )
    assert rows_of(by_sql) == rows_of(wh.units_by_product())
    bad = {t: v.where("nulls > 0").count() for t, v in wh.null_violations().items()}
    assert sum(bad.values()) == 0


def test_batches_can_be_replayed(spark, store):
    docs = [purchase_doc("C1", [sold("A", 2, 3)], 0), purchase_doc("C2", [sold("B", 1, 5)], 9), "junk"]
    invoices = parse_purchases(messages(spark, docs))
    later = parse_purchases(messages(spark, [purchase_doc("C1", [sold("A", 1, 3)], 0)], start=10))
    tables = ("movements", "product_dim", "customer_dim", "time_dim", "sales_fact", "rejects")

    def contents():
        return {t: sorted(map(tuple, store.read(t).collect()), key=repr) for t in tables}

    for write in (batches.sale_batch, batches.warehouse_batch):
        write(invoices, 0, store)
        write(later, 1, store)
    once = contents()
    for write in (batches.sale_batch, batches.warehouse_batch):
        write(later, 1, store)
        write(invoices, 0, store)
        write(later, 1, store)
    assert contents() == once
    assert len(once["sales_fact"]) == 3 and len(once["time_dim"]) == 2


def test_import_batch_can_be_replayed(spark, store, tmp_path):
    drop_files(tmp_path / "in", {"0": import_doc("I0", [item("A", 1, 1)]), "1": "junk"})
    batch = streams.read_imports(spark, str(tmp_path / "in"))
    for _ in range(2):
        batches.import_batch(batch, 0, store)
    assert store.read("import_items").count() == 1
    assert store.read("import_invoices").count() == 1
    assert store.read("movements").count() == 1
    assert store.read("rejects").count() == 1


def test_both_streams_meet_in_the_stock(spark, store, tmp_path):
    drop_files(tmp_path / "in", {"0": import_doc("I0", [item("A", 10, 5)], 10)})
    sales = messages(spark, [
        purchase_doc("C", [sold("A", 3, 6), sold("A", 2, 6)], 20),
        purchase_doc("C", [sold("A", 1, 6), sold("Z", 1, 6)], 5),
    ])
    batches.sale_batch(parse_purchases(sales), 0, store)
    drain_imports(spark, store, tmp_path, clean="off")
    wh = Warehouse(store)
    assert rows_of(wh.stock()) == {("A", "name A", 5, money(6), 50)}
    assert rows_of(wh.low_stock(), "product_id") == {("A",)}
    wh.publish_stock(0, streams_stopped=True)
    time.sleep(0.01)
    batches.sale_batch(parse_purchases(messages(spark, [purchase_doc("C", [sold("A", 1, 6)], 30)], 5)), 1, store)
    wh.publish_stock(1, streams_stopped=True)
    assert wh.table("inventory").count() == 2
    assert rows_of(wh.current_inventory(), "product_id", "quantity") == {("A", 4)}
    assert rows_of(wh.current_inventory("one"), "product_id", "quantity") == {("A", 4)}


def test_snapshots_add_what_came_since(spark, store):
    def sale(batch, *docs):
        rows = parse_purchases(messages(spark, list(docs), start=10 * batch))
        batches.sale_batch(rows, batch, store)

    def receive(batch, rows):
        moved = movements(spark, rows)
        store.append(moved, "movements", batches.IMPORTS, batch)

    wh = Warehouse(store)
    receive(0, [("A", 0, "I0", 0, 10, 5), ("B", 1, "I0", 1, 4, 5)])
    sale(0, purchase_doc("C", [sold("A", 3, 6), sold("Z", 1, 1)], 5))
    receive(1, [("A", 10, "I1", 0, 5, 99)])
    wh.publish_stock(0)
    # The newest batch of each stream is left for later.
    assert rows_of(wh.current_inventory(), "product_id", "quantity") == {("A", 10), ("B", 4)}

    sale(1, purchase_doc("C", [sold("B", 6, 6)], 15))
    receive(2, [("Z", 20, "I2", 0, 2, 10)])
    wh.publish_stock(1)
    assert rows_of(wh.current_inventory(), "product_id", "quantity") == {("A", 12), ("B", 4)}
    wh.publish_stock(1)
    assert rows_of(wh.current_inventory(), "product_id", "quantity") == {("A", 12), ("B", 4)}

    wh.publish_stock(2, streams_stopped=True)
    assert rows_of(wh.current_inventory().drop("last_updated")) == rows_of(wh.stock())
    assert rows_of(wh.stock(), "product_id", "quantity", "sale_prices") == {
        ("A", 12, money(6)), ("B", -2, money(6)), ("Z", 2, money(12))
    }
    wh.publish_stock(3, streams_stopped=True)
    assert rows_of(wh.current_inventory(), "product_id", "quantity") == {("A", 12), ("B", -2), ("Z", 2)}


def test_snapshots_go_on_after_compaction(spark, store, tmp_path):
    wh = Warehouse(store)
    for n in range(3):
        moved = movements(spark, [("A", 10 * n, f"I{n}", 0, 5, 5), (f"N{n}", 10 * n, f"I{n}", 1, 1, 1)])
        store.append(moved, "movements", batches.IMPORTS, n)
        wh.publish_stock(n)
    small = ParquetStore(spark, str(tmp_path / "small"))
    store.compact_into(small)
    assert small.newest_batches("movements") == {"imports": 2}
    assert small.last_snapshot() == store.last_snapshot() == (2, {"imports": 1})
    after = Warehouse(small)
    assert rows_of(after.stock()) == rows_of(wh.stock())
    store.append(movements(spark, [("A", 99, "I9", 0, 1, 1)]), "movements", batches.IMPORTS, 3)
    small.append(movements(spark, [("A", 99, "I9", 0, 1, 1)]), "movements", batches.IMPORTS, 3)
    after.publish_stock(3, streams_stopped=True)
    assert rows_of(after.current_inventory().drop("last_updated")) == rows_of(wh.stock())
    assert rows_of(after.current_inventory(), "product_id", "quantity") == {
        ("A", 16), ("N0", 1), ("N1", 1), ("N2", 1)
    }


def test_snapshot_of_nothing(spark, store):
    wh = Warehouse(store.create())
    wh.publish_stock(0)
    assert wh.current_inventory().count() == 0


class Recorder:
    """Stands for a stream reader or writer; notes the options it is given."""

    def __init__(self):
        self.seen = {}

    @property
    def readStream(self):
        return self

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **kw):
        self.seen.update(kw)
        return self

    def load(self):
        return self.seen


def test_topic_options():
    seen = streams.read_purchase_stream(Recorder(), "host:9092", "in")
    assert seen == {
        "format": "kafka", "kafka.bootstrap.servers": "host:9092", "subscribe": "in",
        "startingOffsets": "latest", "failOnDataLoss": "false",
    }
    seen = streams.read_purchase_stream(
        Recorder(), "h", "in", {"startingOffsets": "earliest", "maxOffsetsPerTrigger": "10"}
    )
    assert seen["startingOffsets"] == "earliest" and seen["maxOffsetsPerTrigger"] == "10"
    assert streams.topic_sink("h", "out") == {"kafka.bootstrap.servers": "h", "topic": "out"}


def test_interval_trigger_and_graceful_stop(spark, store, tmp_path):
    drop_files(tmp_path / "in", {"0": import_doc("I0", [item("A", 1, 1)])})
    stream = streams.read_import_stream(spark, str(tmp_path / "in"), clean="off")
    query = jobs.start_imports(stream, store, str(tmp_path / "cp"), {"processingTime": "1 second"}, "tick")
    query.processAllAvailable()
    jobs.stop_gracefully([query], 20)
    assert not query.isActive
    assert store.read("import_items").count() == 1


def test_a_failing_query_is_noticed(spark, tmp_path):
    class Broken:
        def append(self, *args, **kwargs):
            raise RuntimeError("disk full")

    drop_files(tmp_path / "in", {"0": import_doc("I0", [item("A", 1, 1)])})
    spark.streams.resetTerminated()
    stream = streams.read_import_stream(spark, str(tmp_path / "in"), clean="off")
    jobs.start_imports(stream, Broken(), str(tmp_path / "cp"), DRAIN, name=None)
    with pytest.raises(Exception, match="disk full"):
        jobs.await_any(spark)
    spark.streams.resetTerminated()


def test_preview(spark, capsys):
    batches.preview(spark.range(3), 2)
    assert "only showing top 2 rows" in capsys.readouterr().out


def test_command_line(spark, tmp_path, capsys):
    drop_files(tmp_path / "in", {"0": import_doc("I0", [item("A", 60, 5)]), "1": import_doc("I1", [item("B", 7, 5)])})
    store = ["--store", str(tmp_path / "store")]
    main(["imports", *store, "--checkpoint", str(tmp_path / "cp"), "--input", str(tmp_path / "in"), "--once", "--clean", "off"])
    main(["snapshot", *store, "--id", "0", "--streams-stopped"])
    main(["report", *store, "low_stock"])
    assert "name B" in capsys.readouterr().out
    main(["report", *store, "current_inventory"])
    assert "name A" in capsys.readouterr().out
    main(["report", *store, "units_by_product"])
    assert "total_sold" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["report", *store, "nothing"])


def test_late_import_keeps_earlier_sale(spark, store):
    """A sale may come before the import it draws on, with a snapshot in between."""
    wh = Warehouse(store)
    store.append(movements(spark, [("A", 5, "S1", 0, -3, 9)]), "movements", batches.SALES, 0)
    wh.publish_stock(0, streams_stopped=True)
    store.append(movements(spark, [("A", 0, "I1", 0, 20, 5)]), "movements", batches.IMPORTS, 0)
    levels = spark.createDataFrame([("A", 7)], "product_id string, reorder_level int")
    for snapshot in (1, 2):
        wh.publish_stock(snapshot, streams_stopped=True, reorder_levels=levels)
        newest = wh.current_inventory().drop("last_updated")
        assert rows_of(newest) == rows_of(wh.stock(levels))
        assert rows_of(newest, "product_id", "quantity", "reorder_level") == {("A", 17, 7)}


@pytest.mark.parametrize("half", [False, True])
def test_replay_after_compaction(spark, store, tmp_path, half):
    """The newest batch of each stream runs again on the compacted store."""

    def run(n, into):
        sales = parse_purchases(
            messages(spark, [purchase_doc(f"C{n}", [sold(f"P{n}", 1, 6), sold("A", 2, 6)], n)], start=n)
        )
        batches.sale_batch(sales, n, into)
        batches.warehouse_batch(sales, n, into)

    store.create()
    for n in range(3):
        run(n, store)
    tables = ["movements", "rejects", "product_dim", "customer_dim", "time_dim", "sales_fact"]
    before = {t: sorted(map(str, store.read(t).collect())) for t in tables}
    if half:
        store.append(store.read("sales_fact").limit(0), "sales_fact", batches.STAR, 2)
    small = ParquetStore(spark, str(tmp_path / "small")).create()
    store.compact_into(small)
    run(2, small)
    assert {t: sorted(map(str, small.read(t).collect())) for t in tables} == before
