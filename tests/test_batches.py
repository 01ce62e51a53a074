"""Batches over several tables, the log of finished batches, stock carried over batches, snapshots under late data."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from rows import at, import_doc, item, messages, movements, plan_of, purchase_doc, rows_of, sold
from storeflow.operators import inventory
from storeflow.operators.invoices import explode_purchases, parse_purchases
from storeflow.plans import feeds
from storeflow.plans.feeds import Feed, batch_bytes
from storeflow.schemas import TABLES
from storeflow.sources import commits, reservations, streams
from storeflow.sources.store import SNAPSHOTS, ParquetStore
from storeflow.streaming import batches, jobs
from storeflow.warehouse import Warehouse

DRAIN = {"availableNow": True}
UNTIMED = 99_999
STAR_TABLES = ("product_dim", "customer_dim", "time_dim", "sales_fact")


@pytest.fixture
def store(spark, tmp_path):
    return ParquetStore(spark, str(tmp_path / "store"))


def products(spark, *ids):
    return spark.createDataFrame([(i, f"name {i}") for i in ids], TABLES["product_dim"])


def sales(spark, *docs, start=0):
    return parse_purchases(messages(spark, list(docs), start=start))


def contents(store, tables):
    return {t: sorted(map(str, store.read(t).collect())) for t in tables}


# The log of finished batches


def test_a_batch_that_fails_between_two_tables_is_nowhere(spark, store, monkeypatch):
    first = sales(spark, purchase_doc("C1", [sold("A", 2, 3)], 0))
    second = sales(spark, purchase_doc("C2", [sold("B", 1, 5)], 9), start=10)
    batches.warehouse_batch(first, 0, store)
    before = contents(store, STAR_TABLES)
    whole = ParquetStore(spark, store.root)

    def broken(lines, *_):
        raise RuntimeError("lost")

    for failing in ("sales_fact", "time_rows"):
        with monkeypatch.context() as patch:
            patch.setattr(batches.star, failing, broken)
            with pytest.raises(RuntimeError, match="lost"):
                batches.warehouse_batch(second, 1, store)
        assert contents(store, STAR_TABLES) == before
    # The same after all tables are written but one, in the middle of the writing.
    with pytest.raises(RuntimeError), store.batch(batches.STAR, 1) as writing:
        writing.append(products(spark, "Z"), "product_dim")
        raise RuntimeError("executor lost")
    assert contents(whole, STAR_TABLES) == before
    assert whole.newest_batches("product_dim") == {"star": 0}
    assert len(store.leftovers()) >= 1
    batches.warehouse_batch(second, 1, store)
    assert rows_of(store.read("product_dim"), "product_id") == {("A",), ("B",)}
    assert store.remove_leftovers() >= 1
    assert store.leftovers() == []
    assert store.read("sales_fact").count() == 2


def test_empty_batches_are_known_and_no_data_is_read(spark, store):
    with store.batch("star", 4) as writing:
        writing.append(products(spark), "product_dim")
        written = writing.append(products(spark, "A", "B"), "customer_dim".replace("customer", "product"))
    assert written.count() == 2
    store.append(products(spark), "product_dim", "star", 7)
    assert store.newest_batches("product_dim") == {"star": 7}
    assert [(p.batch_id, p.rows) for p in store.parts("product_dim")] == [(4, 2), (7, 0)]
    jobs_before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    ParquetStore(spark, store.root).newest_batches("product_dim")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == jobs_before


def test_many_entries_are_read_by_a_job(spark, store, monkeypatch):
    for n in range(5):
        store.append(products(spark, f"A{n}"), "product_dim", "one", n)
    monkeypatch.setattr(commits, "READ_HERE", 2)
    again = ParquetStore(spark, store.root)
    assert again.newest_batches("product_dim") == {"one": 4}
    assert again.read("product_dim").count() == 5


def test_entries_are_not_shared_between_tables(spark, store):
    store.append(products(spark, "A"), "product_dim", "star", 0)
    customers = spark.createDataFrame([("C", "c")], TABLES["customer_dim"])
    store.append(customers, "customer_dim", "star", 0)
    assert store.read("product_dim").count() == store.read("customer_dim").count() == 1


def test_compaction_makes_one_batch_for_all_tables(spark, store, tmp_path):
    for n in range(5):
        batches.warehouse_batch(sales(spark, purchase_doc(f"C{n}", [sold(f"P{n}", 1, 2)], n), start=n), n, store)
    small = ParquetStore(spark, str(tmp_path / "small"))
    store.compact_into(small)
    assert {(p.source, p.batch_id) for p in small.log.parts()} == {("star", 3), ("star", 4)}
    assert contents(small, STAR_TABLES) == contents(store, STAR_TABLES)


# One reading for several outputs


def test_outputs_of_one_reading_have_marks_of_their_own(spark, store, tmp_path, monkeypatch):
    log = messages(spark, [purchase_doc("C1", [sold("A", 2, 3), sold("B", 1, 1)], 0), "junk"])
    seen = []

    def notify(records, batch_id):
        seen.append(records.count())

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(batches.star, "sales_fact", broken)
        with pytest.raises(RuntimeError, match="lost"):
            batches.purchase_batch(log, 0, store, notify)
    assert store.read("sales_fact").count() == store.read("product_dim").count() == 0
    assert store.read("movements").count() == 2 and seen == [2]
    parts = store.parts("movements")
    batches.purchase_batch(log, 0, store, notify)
    # Stock and notices were done and are not written again.
    assert store.parts("movements") == parts and seen == [2]
    assert store.read("sales_fact").count() == 2 and store.read("rejects").count() == 1


def test_one_reading_equals_three(spark, tmp_path):
    docs = [[purchase_doc(f"C{k}", [sold(f"P{k % 3}", k + 1, 2)], k)] + ["junk"] * (k == 2) for k in range(5)]
    start = 0
    for part in docs:
        batch = messages(spark, part, start)
        batch.coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
        start += len(part)
    stores = [ParquetStore(spark, str(tmp_path / name)) for name in ("apart", "together")]

    def stream():
        return spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))

    outs = [{"path": str(tmp_path / f"out{k}")} for k in (0, 1)]
    started = jobs.start_purchases(
        stream(), stores[0], str(tmp_path / "cp0"), ("json", outs[0]), DRAIN, (None, None, None)
    )
    started.append(
        jobs.start_purchases_together(stream(), stores[1], str(tmp_path / "cp1"), ("json", outs[1]), DRAIN, None)
    )
    for query in started:
        query.awaitTermination()
    tables = (*STAR_TABLES, "movements", "rejects")
    assert contents(stores[0], tables) == contents(stores[1], tables)
    notices = [rows_of(spark.read.json(out["path"]).select("value")) for out in outs]
    assert notices[0] == notices[1] and len(notices[0]) == 5
    assert {p.batch_id for p in stores[1].parts("movements")} == set(range(5))


def test_messages_are_parsed_once(spark, store, monkeypatch):
    """The parsed batch is kept: what feeds the tables is the cache, whatever reads it."""
    log = messages(spark, [purchase_doc("C1", [sold("A", 2, 3)], 0)])
    plans = []
    append = type(store.batch("x", 0).__enter__()).append

    def noted(self, df, table):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return append(self, df, table)

    monkeypatch.setattr("storeflow.sources.store.Batch.append", noted)
    batches.purchase_batch(log, 0, store)
    assert len(plans) == 6
    # New dimension rows come from a checkpoint, made from the cache as well.
    assert all("InMemoryTableScan" in p or ("ExistingRDD" in p and "from_json" not in p) for p in plans)
    assert sum("InMemoryTableScan" in p for p in plans) >= 3


# Feeds in waves and batches


def test_batch_bytes():
    assert batch_bytes(0) == 1
    assert batch_bytes(10_000) == 2_500
    assert batch_bytes(1 << 50) == feeds.BATCH_BYTES


def test_feed_keeps_its_order_over_waves_and_batches(spark, tmp_path):
    rows = spark.range(1000).withColumn("x", F.col("id") % 7).repartition(5)
    feed = Feed(rows, "parquet", ["id"], "test-feed")
    seen = []

    def note(batch, batch_id):
        seen.append((batch_id, sorted(r["id"] for r in batch.collect())))

    while feed.publish():
        stream = spark.readStream.schema(feed.schema).option("maxBytesPerTrigger", feed.batch_bytes).parquet(feed.inbox)
        query = stream.writeStream.option("checkpointLocation", feed.checkpoint).trigger(**DRAIN).foreachBatch(note)
        query.start().awaitTermination()
    assert [n for n, _ in seen] == list(range(len(seen))) and len(seen) >= 4
    assert [i for _, ids in seen for i in ids] == list(range(1000))


def test_stream_killed_in_the_middle_goes_on(spark, store, tmp_path):
    """A query stopped while a batch runs, started again from its checkpoint, leaves each row once."""
    start = 0
    for k in range(6):
        batch = messages(spark, [purchase_doc(f"C{k}{n}", [sold(f"P{n}", 1, 2)], k) for n in range(20)], start)
        batch.coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
        start += 20

    def run(trigger):
        stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
        return jobs.start_purchases_together(stream, store, str(tmp_path / "cp"), trigger=trigger, name=None)

    query = run({"processingTime": "0 seconds"})
    while query.lastProgress is None:
        time.sleep(0.05)
    time.sleep(0.3)
    query.stop()
    assert store.read("sales_fact").count() < 120
    run(DRAIN).awaitTermination()
    assert store.read("sales_fact").count() == store.read("sales_fact").select("customer_id").distinct().count() == 120
    assert store.read("movements").count() == 120
    assert store.read("product_dim").count() == 20


@pytest.mark.parametrize("moved", [0, 2, 4])
def test_archive_and_inbox_are_read_once(spark, tmp_path, moved):
    inbox, kept = tmp_path / "in", tmp_path / "kept"
    inbox.mkdir()
    for k in range(4):
        (inbox / f"{k}.json").write_text(import_doc(f"I{k}", [item("A", k + 1, 1)]) + "\n")
    target = kept / str(inbox).lstrip("/")
    target.mkdir(parents=True)
    for k in range(moved):
        text = (inbox / f"{k}.json").read_text()
        (target / f"{k}.json").write_text(text)
        if k:  # one file is still seen in both places
            (inbox / f"{k}.json").unlink()
    found = streams.read_archived_imports(spark, str(inbox), str(kept))
    assert sorted(r["import_id"] for r in found.collect()) == ["I0", "I1", "I2", "I3"]
    assert streams.read_archived_imports(spark, str(tmp_path / "none"), str(tmp_path / "no")).count() == 0


# The guard over batches


def requests(rng, n):
    return [
        purchase_doc(f"C{k}", [sold(f"P{rng.randrange(4)}", rng.randrange(0, 5), 1) for _ in range(rng.randint(1, 3))], k)
        for k in range(n)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_guard_is_the_same_over_any_split(spark, store, seed, monkeypatch):
    monkeypatch.setattr(reservations, "SUM_EVERY", 3)
    rng = random.Random(seed)
    docs = requests(rng, 24)
    stock = spark.createDataFrame([("P0", 9), ("P1", 0), ("P2", 30)], "product_id string, quantity bigint")
    at, n = 0, 0
    while at < len(docs):
        size = rng.randint(1, 6)
        batch = sales(spark, *docs[at : at + size], start=at)
        batches.guard_batch(batch, n, store, stock)
        if rng.random() < 0.4:
            batches.guard_batch(batch, n, store, stock)  # runs again
        at, n = at + size, n + 1
    lines = explode_purchases(sales(spark, *docs)).select("source_id", "line_no", "customer_id", "product_id", "quantity")
    whole = inventory.oversell_guard(lines, stock, ["source_id", "line_no"])
    assert rows_of(store.read("accepted_lines")) == rows_of(whole.select(*TABLES["accepted_lines"].fieldNames()))
    taken = rows_of(whole.groupBy("product_id").agg(F.sum("fulfilled")))
    assert rows_of(reservations.reserved_before(store, batches.GUARD, n)) == taken
    if n >= 4:
        assert {p.batch_id for p in store.parts("reservation_totals")} >= {2}


def test_guard_goes_on_after_compaction(spark, store, tmp_path, monkeypatch):
    monkeypatch.setattr(reservations, "SUM_EVERY", 2)
    stock = spark.createDataFrame([("P0", 7)], "product_id string, quantity bigint")
    docs = [purchase_doc(f"C{k}", [sold("P0", 1, 1)], k) for k in range(9)]
    for n in range(5):
        batches.guard_batch(sales(spark, docs[n], start=n), n, store, stock)
    small = ParquetStore(spark, str(tmp_path / "small"))
    store.compact_into(small)
    for n in (4, 5, 6, 7, 8):
        batches.guard_batch(sales(spark, docs[n], start=n), n, small, stock)
    assert sorted(r["customer_id"] for r in small.read("accepted_lines").collect()) == [f"C{k}" for k in range(7)]


def test_guard_reads_a_sum_and_what_came_after(spark, store, monkeypatch):
    monkeypatch.setattr(reservations, "SUM_EVERY", 4)
    stock = spark.createDataFrame([("P0", 100)], "product_id string, quantity bigint")
    for n in range(10):
        batches.guard_batch(sales(spark, purchase_doc("C", [sold("P0", 1, 1)], n), start=n), n, store, stock)
    files = reservations.reserved_before(store, batches.GUARD, 10).inputFiles()
    assert {f.split("batch_id=")[1].split("/")[0] for f in files if "/reservations/" in f} == {"8", "9"}
    assert len([f for f in files if "/reservation_totals/" in f]) == 1


# Snapshots under late data


@pytest.mark.parametrize("seed", range(4))
def test_snapshots_equal_stock_in_any_order_of_arrival(spark, store, seed):
    rng = random.Random(seed)
    wh, placed = Warehouse(store), []
    for k in range(60):
        receipt = rng.random() < 0.4
        moment = UNTIMED if rng.random() < 0.08 else rng.randrange(50)
        units = rng.randint(1, 9) * (1 if receipt else -1)
        placed.append((receipt, (f"P{rng.randrange(6)}", moment, f"{'I' if receipt else 'S'}{k:03d}", k % 2, units, rng.randint(1, 9))))
    rng.shuffle(placed)
    counts = {batches.IMPORTS: 0, batches.SALES: 0}
    for snapshot in range(6):
        wave = placed[10 * snapshot : 10 * snapshot + 10]
        for source, receipt in ((batches.IMPORTS, True), (batches.SALES, False)):
            rows = [m for r, m in wave if r == receipt]
            if rows:
                moved = movements(spark, rows).withColumn("event_time", F.nullif("event_time", F.lit(at(UNTIMED))))
                store.append(moved, "movements", source, counts[source])
                counts[source] += 1
        wh.publish_stock(snapshot, streams_stopped=True)
        assert rows_of(wh.current_inventory().drop("last_updated")) == rows_of(wh.stock())


def test_only_reopened_products_are_read_again(spark, store, monkeypatch):
    wh = Warehouse(store)
    store.append(movements(spark, [("A", 10, "I1", 0, 5, 5), ("B", 10, "I1", 1, 5, 5)]), "movements", batches.IMPORTS, 0)
    wh.publish_stock(0, streams_stopped=True)
    store.append(movements(spark, [("A", 1, "I2", 0, 2, 9), ("B", 20, "I2", 1, 1, 9)]), "movements", batches.IMPORTS, 1)
    looked_up = []
    whole = inventory.stock_on_hand

    def noted(moves, *args, **kwargs):
        looked_up.append({r["product_id"] for r in moves.select("product_id").collect()})
        return whole(moves, *args, **kwargs)

    monkeypatch.setattr(inventory, "stock_on_hand", noted)
    wh.publish_stock(1, streams_stopped=True)
    assert looked_up == [{"A"}]


def test_newest_inventory_reads_one_snapshot(spark, store):
    wh = Warehouse(store)
    for n in range(4):
        store.append(movements(spark, [("A", n, f"I{n}", 0, 1, 1)]), "movements", batches.IMPORTS, n)
        wh.publish_stock(n, streams_stopped=True)
    files = wh.current_inventory().inputFiles()
    assert {f.split("batch_id=")[1].split("/")[0] for f in files} == {"3"}
    assert rows_of(wh.current_inventory(), "product_id", "quantity") == {("A", 4)}
    assert len(store.snapshot_parts("inventory", 2)) == 1 and SNAPSHOTS == "snapshots"


# Facts by day


def days_of(df) -> set:
    return {f.split("day=")[1].split("/")[0] for f in df.inputFiles() if "day=" in f}


def sell_on(spark, day, batch, store):
    docs = [purchase_doc(f"C{k}", [sold("A", k + 1, 2)], 86_400 * day + k) for k in range(3)]
    batches.warehouse_batch(sales(spark, *docs, start=10 * batch), batch, store)


def test_a_report_reads_only_its_days(spark, store):
    for n in range(6):
        sell_on(spark, n, n, store)
    wh = Warehouse(store)
    wh.lay_out_facts(0)
    some = F.col("day") == at(86_400 * 2).day
    report = wh.revenue_by_minute_of(some)
    plan = plan_of(report)
    by_day = [line for line in plan.split("\n") if line.startswith("PartitionFilters:")]
    assert any("day" in line and "dynamicpruningexpression" in line for line in by_day)
    assert [r["total_quantity_sold"] for r in report.collect()] == [6]
    assert len(days_of(wh.table("sales_fact_by_day"))) == 6
    assert rows_of(wh.revenue_by_minute_of(F.lit(True))) == rows_of(wh.revenue_by_minute())


def test_layout_goes_on_and_takes_what_is_not_laid_out_yet(spark, store, tmp_path):
    wh = Warehouse(store)
    for n in range(5):
        sell_on(spark, n % 2, n, store)
        if n in (1, 2):
            wh.lay_out_facts(n)
    assert store.laid_out() == {"star": 2}
    assert store.rows_of(store.parts("sales_fact_by_day"), "sales_fact_by_day").count() == 9
    whole = rows_of(wh.revenue_by_minute())
    assert rows_of(wh.revenue_by_minute_of(F.lit(True))) == whole
    small = ParquetStore(spark, str(tmp_path / "small"))
    store.compact_into(small)
    after = Warehouse(small)
    assert rows_of(after.revenue_by_minute_of(F.lit(True))) == whole
    after.lay_out_facts(9)
    assert rows_of(after.revenue_by_minute_of(F.lit(True))) == whole
    assert after.table("sales_fact_by_day").count() == 15
    after.lay_out_facts(10)
    assert after.table("sales_fact_by_day").count() == 15


# What a batch and a feed cost


def test_a_feed_makes_its_documents_once(spark):
    made = spark.sparkContext.accumulator(0)

    def note(value):
        made.add(1)
        return value

    documents = spark.range(500).repartition(4).withColumn("x", F.udf(note, "long")("id"))
    feed = Feed(documents, "parquet", ["id"], "once-feed")
    assert made.value == 500 and not documents.is_cached
    assert sum(spark.read.parquet(f.path).count() for f in feed.waiting) == 500


def test_a_wave_does_not_end_in_a_batch_of_one_small_file(spark):
    rows = spark.range(4000).withColumn("x", F.sha2(F.col("id").cast("string"), 256))
    feed = Feed(rows, "parquet", ["id"], "even-feed")
    while feed.publish():
        stream = spark.readStream.schema(feed.schema).option("maxBytesPerTrigger", feed.batch_bytes).parquet(feed.inbox)
        seen = []
        query = stream.writeStream.option("checkpointLocation", feed.checkpoint).trigger(**DRAIN)
        query.foreachBatch(lambda batch, _: seen.append(len(batch.inputFiles()))).start().awaitTermination()
        assert len(seen) == 2


@pytest.mark.parametrize("per_file, files", [(1, 4), (1000, 1)])
def test_large_partitions_are_written_as_they_are(spark, store, monkeypatch, per_file, files):
    monkeypatch.setattr(batches, "FILE_INVOICES", per_file)
    docs = [purchase_doc(f"C{n}", [sold("A", 2, 3), sold("B", 1, 1)], n) for n in range(40)]
    batches.purchase_batch(messages(spark, docs).repartition(4), 0, store)
    for table in ("movements", "sales_fact"):
        assert store.read(table).count() == 80
        assert len(store.read(table).inputFiles()) == files
    assert store.read("customer_dim").count() == 40
