import pytest
from pyspark.sql import functions as F

from rows import rows_of
from storeflow.schemas import TABLES
from storeflow.sources.store import JdbcStore, ParquetStore

PRODUCTS = TABLES["product_dim"]


def products(spark, *ids):
    return spark.createDataFrame([(i, f"name {i}") for i in ids], PRODUCTS)


@pytest.fixture
def store(spark, tmp_path):
    return ParquetStore(spark, str(tmp_path / "store"))


def test_missing_table_is_empty(store):
    assert store.read("product_dim").columns == PRODUCTS.fieldNames()
    assert store.read("product_dim").count() == 0


def test_append_and_read(spark, store):
    store.append(products(spark, "A"), "product_dim", "star", 0)
    store.append(products(spark, "B"), "product_dim", "star", 1)
    assert rows_of(store.read("product_dim"), "product_id") == {("A",), ("B",)}
    assert rows_of(store.read("product_dim", before_batch=1), "product_id") == {("A",)}
    assert store.read("product_dim", before_batch=0).count() == 0


def test_replay_replaces_its_own_batch(spark, store):
    store.append(products(spark, "A"), "product_dim", "star", 0)
    store.append(products(spark, "B", "C"), "product_dim", "star", 1)
    store.append(products(spark, "B"), "product_dim", "star", 1)
    assert rows_of(store.read("product_dim"), "product_id") == {("A",), ("B",)}
    store.append(products(spark), "product_dim", "star", 1)
    assert rows_of(store.read("product_dim"), "product_id") == {("A",)}


def test_streams_do_not_touch_each_other(spark, store):
    store.append(products(spark, "A"), "product_dim", "one", 0)
    store.append(products(spark, "B"), "product_dim", "two", 0)
    store.append(products(spark), "product_dim", "one", 0)
    assert rows_of(store.read("product_dim"), "product_id") == {("B",)}


def test_columns_are_pruned_and_batches_skipped(spark, store, capsys):
    store.append(products(spark, "A"), "product_dim", "star", 0)
    store.append(products(spark, "B"), "product_dim", "star", 1)
    store.read("product_dim", before_batch=1).select("product_id").explain("formatted")
    plan = capsys.readouterr().out
    assert "ReadSchema: struct<product_id:string>" in plan
    assert "(batch_id" in plan.split("PartitionFilters:")[1].split("\n")[0]


def test_compaction_keeps_rows_and_batch_order(spark, store, tmp_path):
    for n in range(4):
        store.append(products(spark, f"A{n}"), "product_dim", "one", n)
    store.append(products(spark, "B"), "product_dim", "two", 0)
    small = ParquetStore(spark, str(tmp_path / "small"))
    store.compact_into(small)
    assert rows_of(small.read("product_dim")) == rows_of(store.read("product_dim"))
    files = {f.rsplit("/", 1)[0] for f in small.read("product_dim").inputFiles()}
    # The history of "one", and the newest batch of each stream, which may be replayed.
    assert len(files) == 3
    small.append(products(spark, "A9"), "product_dim", "one", 4)
    assert small.read("product_dim").count() == 6
    assert small.read("product_dim", before_batch=4).count() == 5


class FakeDatabase:
    """Stands for a session whose JDBC calls are only noted down."""

    def __init__(self, spark, recorded=False):
        self.real = spark
        self.recorded = recorded
        self.calls = []

    @property
    def read(self):
        return self

    def createDataFrame(self, rows, schema):
        return FakeRows(self, schema.split(), rows)

    def jdbc(self, url, table, **kw):
        self.calls.append(("read", table, kw))
        return self.real.range(1 if self.recorded else 0)


class FakeRows:
    def __init__(self, db, columns, rows=None):
        self.db, self.columns, self.rows = db, columns, rows

    def select(self, *columns):
        return FakeRows(self.db, columns)

    @property
    def write(self):
        return self

    def jdbc(self, url, table, mode, properties):
        self.db.calls.append((mode, table, list(self.columns) if self.rows is None else self.rows))


def test_jdbc_append_writes_then_records(spark):
    db = FakeDatabase(spark)
    store = JdbcStore(db, "jdbc:x", {"user": "u"})
    store.append(FakeRows(db, []), "sales_fact", "star", 3)
    assert [c[0] for c in db.calls] == ["read", "append", "append"]
    written = db.calls[1]
    assert written[1] == "sales_fact" and "sale_id" not in written[2] and "time_id" in written[2]
    assert db.calls[2][1:] == ("batch_log", [("sales_fact", "star", 3)])


def test_jdbc_replay_writes_nothing(spark):
    db = FakeDatabase(spark, recorded=True)
    JdbcStore(db, "jdbc:x", {}).append(FakeRows(db, []), "product_dim", "star", 3)
    assert [c[0] for c in db.calls] == ["read"]


def test_jdbc_reads_table_and_subquery(spark):
    db = FakeDatabase(spark)
    split = {"column": "id", "lowerBound": 0, "upperBound": 9, "numPartitions": 3}
    store = JdbcStore(db, "jdbc:x", {"user": "u"}, splits={"time_dim": split})
    store.read("time_dim")
    store.query("SELECT MAX(id) FROM time_dim", "latest")
    assert db.calls[0] == ("read", "time_dim", {"properties": {"user": "u"}, **split})
    assert db.calls[1][1] == "(SELECT MAX(id) FROM time_dim) latest"


def test_jdbc_batch_stages_tables_and_moves_them_in_one_transaction(spark):
    db, ran = FakeDatabase(spark), []
    store = JdbcStore(db, "jdbc:x", {"user": "u"}, run=ran.append)
    with store.batch("star", 3) as writing:
        writing.append(FakeRows(db, []), "sales_fact")
        writing.append(FakeRows(db, []), "product_dim")
        assert ran == []
    assert [(c[0], c[1]) for c in db.calls[1:]] == [
        ("overwrite", "stage_star_sales_fact"), ("overwrite", "stage_star_product_dim")
    ]
    assert len(ran) == 1
    products_in, sales_in, logged = ran[0]
    assert products_in == (
        "INSERT INTO product_dim (product_id, product_name) "
        "SELECT product_id, product_name FROM stage_star_product_dim"
    )
    assert "sale_id" not in sales_in and "FROM stage_star_sales_fact" in sales_in
    assert logged.endswith("VALUES ('*', 'star', 3)")


def test_jdbc_batch_that_fails_moves_nothing(spark):
    db, ran = FakeDatabase(spark), []
    store = JdbcStore(db, "jdbc:x", {}, run=ran.append)
    with pytest.raises(RuntimeError), store.batch("star", 3) as writing:
        writing.append(FakeRows(db, []), "product_dim")
        raise RuntimeError("lost")
    assert ran == []


def test_jdbc_batch_that_is_recorded_is_skipped(spark):
    db, ran = FakeDatabase(spark, recorded=True), []
    store = JdbcStore(db, "jdbc:x", {}, run=ran.append)
    assert store.finished("star", 3)
    with store.batch("star", 3) as writing:
        writing.append(FakeRows(db, []), "product_dim")
    assert ran == [] and all(c[0] == "read" for c in db.calls)


def test_jdbc_splits_ask_for_bounds(spark):
    class Bounded(FakeDatabase):
        def jdbc(self, url, table, **kw):
            self.calls.append((table, kw))
            return self.real.createDataFrame([(5, 90)], "low int, high int")

    db = Bounded(spark)
    store = JdbcStore(db, "jdbc:x", {"user": "u"}, splits={"time_dim": {"column": "id", "numPartitions": 4}})
    store.read("time_dim")
    store.query("SELECT * FROM sales_fact WHERE quantity > 1", "s", split="time_id", parts=8)
    asked = [table for table, _ in db.calls]
    assert asked[0] == "(SELECT MIN(id) AS low, MAX(id) AS high FROM time_dim) ends"
    assert db.calls[1] == (
        "time_dim",
        {"properties": {"fetchsize": "10000", "user": "u"}, "column": "id", "numPartitions": 4, "lowerBound": 5, "upperBound": 90},
    )
    assert asked[2].startswith("(SELECT MIN(time_id) AS low, MAX(time_id) AS high FROM (SELECT * FROM sales_fact")
    assert db.calls[3][1]["numPartitions"] == 8 and db.calls[3][1]["column"] == "time_id"


def test_jdbc_empty_table_is_read_in_one_part(spark):
    class Empty(FakeDatabase):
        def jdbc(self, url, table, **kw):
            self.calls.append((table, kw))
            return self.real.createDataFrame([(None, None)], "low int, high int")

    db = Empty(spark)
    JdbcStore(db, "jdbc:x", {}, splits={"time_dim": {"column": "id", "numPartitions": 4}}).read("time_dim")
    assert db.calls[1] == ("time_dim", {"properties": {}})
