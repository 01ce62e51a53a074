"""One key with a third of all rows or more: same results, split work."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from oracle import TESTDATA, differences, duck_rows
from rows import money, movements, plan_of, rows_of
from storeflow import catalog
from storeflow.operators import inventory
from storeflow.oracles import ORACLES
from storeflow.plans import skew
from storeflow.plans.views import LINE_ORDER, Retail

FOLDER = str(TESTDATA / "sf0.001")
ORDER = ["event_time", "source_id", "line_no"]


def skewed(spark, n=900, seed=1):
    """Signed movements; half of them of product HOT, many at the same second."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        product = "HOT" if rng.random() < 0.5 else f"P{rng.randrange(20)}"
        units = rng.randint(1, 9) * (1 if rng.random() < 0.5 else -1)
        rows.append((product, rng.randrange(60), f"S{i:05d}", rng.randrange(3), units, rng.randint(1, 99)))
    return rows, movements(spark, rows)


def test_profile_counts_keys_and_heavy_ones(spark):
    rows, df = skewed(spark)
    profile = skew.profile_keys(df, "product_id", heavy_rows=200)
    hot = sum(r[0] == "HOT" for r in rows)
    assert (profile.rows, profile.largest) == (len(rows), hot)
    assert rows_of(profile.heavy) == {("HOT",)}


def test_profile_of_nothing(spark):
    profile = skew.profile_keys(movements(spark, []), "product_id")
    assert (profile.rows, profile.largest, profile.heavy) == (0, 0, None)


def test_profile_ignores_null_keys(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    profile = skew.profile_keys(df, "k", heavy_rows=1)
    assert (profile.largest, profile.heavy) == (1, None)


def test_heavy_keys_are_bounded_by_their_share(spark, monkeypatch):
    monkeypatch.setattr(skew, "HEAVY_KEYS", 5)
    df = spark.range(100).select(F.when(F.col("id") < 70, 1).when(F.col("id") < 91, 2).otherwise(3).alias("k"))
    assert rows_of(skew.profile_keys(df, "k", heavy_rows=5).heavy) == {(1,), (2,)}


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
@pytest.mark.parametrize("heavy_rows", [200, 10_000])
def test_lookup_join_paths_agree(spark, monkeypatch, broadcast_rows, heavy_rows):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", broadcast_rows)
    rows, df = skewed(spark)
    names = sorted({r[0] for r in rows})[1:] + ["unused"]
    lookup = spark.createDataFrame([(p, i) for i, p in enumerate(names)], "product_id string, n int")
    joined = skew.lookup_join(df, lookup, "product_id", len(names), heavy_rows=heavy_rows)
    got = sorted((r["source_id"], r["n"]) for r in joined.collect())
    index = dict(zip(names, range(len(names))))
    assert got == sorted((r[2], index[r[0]]) for r in rows if r[0] in index)


def running_by_hand(rows):
    total, out = defaultdict(int), {}
    for product, seconds, source, line, units, _ in sorted(rows, key=lambda r: (r[1], r[2], r[3])):
        out[source] = total[product]
        total[product] += units
    return out


@pytest.mark.parametrize("heavy_rows", [40, 100, 10_000])
def test_running_sum(spark, heavy_rows):
    rows, df = skewed(spark)
    profile = skew.profile_keys(df, "product_id", heavy_rows=heavy_rows)
    out = skew.running_before(df, "quantity", ORDER, profile, "before")
    got = {r["source_id"]: r["before"] for r in out.collect()}
    assert got == running_by_hand(rows)


def test_running_sum_splits_the_heavy_key(spark, monkeypatch):
    frozen = []
    freeze = skew.freeze
    monkeypatch.setattr(skew, "freeze", lambda df: frozen.append(freeze(df)) or frozen[-1])
    _, df = skewed(spark)
    profile = skew.profile_keys(df, "product_id", heavy_rows=40)
    skew.running_before(df, "quantity", ORDER, profile, "before")
    sizes = frozen[-1].groupBy("_range").count().collect()
    assert len(sizes) > 10
    assert max(r["count"] for r in sizes) < 4 * 40


def test_equal_rows_of_a_hot_key_are_spread(spark, monkeypatch):
    """Ranges follow the rows, with one shuffle partition and nothing to tell rows apart as well."""
    frozen = []
    freeze = skew.freeze
    monkeypatch.setattr(skew, "freeze", lambda df: frozen.append(freeze(df)) or frozen[-1])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        df = spark.range(2000).select(F.lit("A").alias("k"), F.lit(0).alias("o"), F.lit(1).alias("v"))
        profile = skew.profile_keys(df, "k", heavy_rows=100)
        out = skew.running_before(df, "v", ["o"], profile, "before")
        assert sorted(r["before"] for r in out.collect()) == list(range(2000))
        assert max(r["count"] for r in frozen[-1].groupBy("_range").count().collect()) < 500
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def guard_by_hand(rows, stock):
    left, out = dict(stock), {}
    for product, seconds, source, line, units, _ in sorted(rows, key=lambda r: (r[1], r[2], r[3])):
        give = min(units, max(0, left.get(product, 0)))
        if give > 0:
            out[source] = give
            left[product] -= give
    return out


@pytest.mark.parametrize("heavy_rows", [40, 10_000])
def test_oversell_guard_by_hand(spark, heavy_rows):
    rows, df = skewed(spark, seed=2)
    rows = [(p, s, src, n, abs(q), c) for p, s, src, n, q, c in rows]
    levels = {f"P{i}": i for i in range(0, 20, 2)} | {"HOT": 700, "UNASKED": 3}
    stock = spark.createDataFrame(list(levels.items()), "product_id string, quantity int")
    out = inventory.oversell_guard(movements(spark, rows), stock, ORDER, heavy_rows=heavy_rows)
    assert {r["source_id"]: r["fulfilled"] for r in out.collect()} == guard_by_hand(rows, levels)


def stock_by_hand(rows):
    stock = {}
    for product, seconds, source, line, units, cost in sorted(rows, key=lambda r: (r[1], r[2], r[3])):
        if units > 0 and product not in stock:
            stock[product] = [0, money(cost) * money("1.2")]
        if product in stock:
            stock[product][0] += units
    return {p: (q, c.quantize(money("0.01"))) for p, (q, c) in stock.items()}


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
@pytest.mark.parametrize("heavy_rows", [40, 10_000])
def test_stock_on_hand_by_hand(spark, monkeypatch, broadcast_rows, heavy_rows):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", broadcast_rows)
    rows, df = skewed(spark, seed=3)
    out = inventory.stock_on_hand(df, ORDER, heavy_rows=heavy_rows).collect()
    assert {r["product_id"]: (r["quantity"], r["sale_prices"]) for r in out} == stock_by_hand(rows)


@pytest.mark.parametrize("heavy_rows", [5, 30])
def test_ties_of_heavy_products(spark, heavy_rows):
    log = Retail(spark, FOLDER).inventory_log()
    out = inventory.current_inventory(log, "keep", heavy_rows=heavy_rows)
    assert differences(out, duck_rows(FOLDER, ORACLES["current_inventory_ties"])) == []


def test_stock_queries_with_every_product_heavy(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    r = Retail(spark, FOLDER)
    out = inventory.stock_on_hand(r.movements(), LINE_ORDER, heavy_rows=5)
    named = inventory.named(out, r.products())
    assert differences(named, duck_rows(FOLDER, ORACLES["stock_on_hand"])) == []


def test_guard_query_with_every_product_heavy(spark):
    r = Retail(spark, FOLDER)
    stock = catalog._opening_stock(r)
    out = inventory.oversell_guard(r.sold(), stock, LINE_ORDER, heavy_rows=5)
    assert differences(out, duck_rows(FOLDER, ORACLES["oversell_guard"])) == []


DOCUMENT_QUERIES = [
    "import_items", "import_invoices", "import_rejects", "purchase_lines", "notifications", "purchase_messages",
    "stream_import_items", "stream_import_invoices", "stream_stock", "stream_inventory", "stream_notifications",
    "stream_sales_fact", "stream_star_reports",
]


@pytest.mark.parametrize("name", DOCUMENT_QUERIES)
def test_document_size_does_not_show(spark, monkeypatch, name):
    from storeflow import oracles
    from storeflow.plans import views

    monkeypatch.setattr(views, "DOCUMENT_LINES", 3)
    sql = oracles.purchase_messages(3) if name == "purchase_messages" else ORACLES[name]
    assert differences(catalog.QUERIES[name](spark, FOLDER), duck_rows(FOLDER, sql)) == []


def test_long_orders_become_several_documents(spark, monkeypatch):
    docs = Retail(spark, FOLDER).import_documents(document_lines=3)
    assert docs.where("first_line > 0").count() > 0
    assert docs.agg(F.max(F.size("items"))).first()[0] == 3


def test_an_order_of_equal_lines_is_spread(spark, tmp_path, monkeypatch):
    from storeflow.plans import views

    monkeypatch.setattr(views, "DOCUMENT_LINES", 50)
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").where("l_linestatus = 'F'")
    copies = lines.limit(1).crossJoin(spark.range(1000)).drop("id")
    copies.unionByName(lines).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.read.parquet(f"{FOLDER}/part.parquet").write.parquet(str(tmp_path / "part.parquet"))
    docs = Retail(spark, str(tmp_path)).import_documents()
    sizes = docs.agg(F.sum(F.size("items")), F.max(F.size("items"))).first()
    assert sizes[0] == 1000 + lines.count() and sizes[1] <= 50


def test_adaptive_split_of_a_skewed_join(spark):
    """Joins left to Spark are split by it when one key dominates."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.rand(1) < 0.5, F.lit(7)).otherwise(F.col("id") % 100)
        lines = spark.range(0, 200_000, 1, 8).select(key.alias("product_id"), "id")
        parts = spark.range(100).select(F.col("id").alias("product_id"), F.lit("x").alias("name"))
        joined = lines.join(parts, "product_id")
        assert joined.groupBy("name").count().collect()[0]["count"] == 200_000
        joined.collect()
        assert "skew=true" in plan_of(joined, "simple")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("buckets", [1, 1 << 17])
def test_the_largest_key_is_found_whatever_the_groups(spark, monkeypatch, buckets):
    monkeypatch.setattr(skew, "BUCKETS", buckets)
    df = spark.createDataFrame([(k,) for k in [1] * 5 + [2] * 3 + [None] * 9], "k long")
    assert skew.no_key_above(df, "k", 5) and not skew.no_key_above(df, "k", 4)
    assert skew.no_key_above(df.limit(0), "k", 0)
