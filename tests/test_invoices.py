import json

from pyspark.sql import functions as F

from rows import at, import_doc, item, messages, money, purchase_doc, rows_of, sold
from storeflow.functions.columns import with_event_time
from storeflow.operators import invoices
from storeflow.sources.streams import read_imports


def read_docs(spark, tmp_path, docs):
    (tmp_path / "in.json").write_text("\n".join(docs))
    return read_imports(spark, str(tmp_path))


def purchase_lines(spark, docs):
    return invoices.explode_purchases(invoices.parse_purchases(messages(spark, docs)))


def test_import_items_and_headers(spark, tmp_path):
    docs = [import_doc("I1", [item("A1", 2, 10), item("A2", 1, 5)]), import_doc("I2", [item("A1", 3, 11)], 60)]
    lines = invoices.explode_imports(read_docs(spark, tmp_path, docs))
    assert rows_of(lines, "import_id", "line_no", "product_id", "quantity") == {
        ("I1", 0, "A1", 2), ("I1", 1, "A2", 1), ("I2", 0, "A1", 3)
    }
    headers = invoices.import_invoices(with_event_time(lines, "delivery_hour"))
    assert rows_of(headers) == {("I1", at(0), money(25)), ("I2", at(60), money(33))}
    assert rows_of(invoices.import_items(lines), "id") == {("I1-0",), ("I1-1",), ("I2-0",)}


def test_cents_are_kept(spark):
    lines = purchase_lines(spark, [purchase_doc("C1", [sold("A", 1, 10.5), sold("B", 1, 10.49)])])
    assert rows_of(lines, "price") == {(money("10.5"),), (money("10.49"),)}


def test_malformed_and_empty_imports_become_rejects(spark, tmp_path):
    missing = json.dumps({"import_id": "I8", "delivery_hour": str(at(0)), "total_invoice_amount": 0})
    docs = ["not json", import_doc("I9", [], total=0), missing, import_doc("I1", [item("A", 1, 1)])]
    read = read_docs(spark, tmp_path, docs).cache()
    assert rows_of(invoices.explode_imports(read), "import_id") == {("I1",)}
    rejects = invoices.import_rejects(read)
    assert rows_of(rejects, "source_id", "reason") == {
        (None, "unreadable"), ("I9", "no items"), ("I8", "no items")
    }
    assert rows_of(rejects.where("source_id is null"), "payload") == {("not json",)}
    read.unpersist()


def test_malformed_and_empty_purchases_become_rejects(spark):
    docs = ["not json", purchase_doc("C1", []), purchase_doc("C2", [sold("A", 1, 1)])]
    parsed = invoices.parse_purchases(messages(spark, docs))
    assert rows_of(invoices.explode_purchases(parsed), "customer_id") == {("C2",)}
    rejects = invoices.purchase_rejects(parsed)
    assert {(r["payload"], r["reason"]) for r in rejects.collect()} == {
        (docs[0], "unreadable"), (docs[1], "no items")
    }


def test_bad_quantity_keeps_the_line(spark):
    bad, fraction = dict(sold("A", 1, 1), quantity="x"), dict(sold("B", 1, 1), quantity=2.0)
    good = sold("C", 3, 1)
    lines = purchase_lines(spark, [purchase_doc("C1", [bad, fraction, good])])
    assert rows_of(lines, "product_id", "quantity") == {("A", None), ("B", None), ("C", 3)}


def test_bad_time_is_null(spark):
    doc = json.loads(purchase_doc("C1", [sold("A", 1, 1)])) | {"timestamp": "nope"}
    lines = with_event_time(purchase_lines(spark, [json.dumps(doc)]), "timestamp")
    assert rows_of(lines, "timestamp") == {(None,)}


def test_message_id_sorts_like_the_log(spark):
    rows = [("t", 0, 9, b"x"), ("t", 0, 10, b"y"), ("t", 11, 2, b"z"), ("t", 2, 5, b"w")]
    log = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value binary")
    ordered = log.orderBy(invoices.message_id(log.columns)).select("partition", "offset").collect()
    assert [tuple(r) for r in ordered] == [(0, 9), (0, 10), (2, 5), (11, 2)]


def test_message_id_without_a_log(spark):
    plain = spark.createDataFrame([(b"x",), (b"y",)], "value binary")
    ids = plain.select(invoices.message_id(plain.columns)).distinct()
    assert ids.count() == 2


def test_notification_keeps_the_text_of_the_time(spark):
    doc = json.loads(purchase_doc("C1", [sold("A", 2, 3)])) | {"timestamp": "sometime"}
    sent = [json.loads(r["value"]) for r in invoices.notifications(purchase_lines(spark, [json.dumps(doc)])).collect()]
    assert sent == [
        {
            "customer_id": "C1", "customer_name": "customer C1", "total_invoice_amount": 6.0,
            "timestamp": "sometime", "product_id": "A", "product_name": "name A",
            "quantity": 2, "price": 3.0, "total_price": 6.0,
        }
    ]


def test_notification_leaves_out_nulls(spark):
    doc = purchase_doc("C1", [dict(sold("A", 1, 3), product_name=None)])
    sent = invoices.notifications(purchase_lines(spark, [doc])).collect()
    assert "product_name" not in json.loads(sent[0]["value"])


def test_messages_round_trip(spark):
    df = spark.createDataFrame([("C1", "ann", 1), ("C2", "bob", 2)], "customer_id string, name string, n int")
    out = invoices.to_messages(df, "customer_id")
    back = out.select("key", F.from_json("value", "customer_id string, name string, n int").alias("v"))
    assert rows_of(back, "key", "v.name", "v.n") == {("C1", "ann", 1), ("C2", "bob", 2)}


def test_notices_carry_a_key(spark):
    lines = invoices.explode_purchases(invoices.parse_purchases(messages(spark, [purchase_doc("C1", [sold("A", 2, 3), sold("B", 1, 1)])])))
    keyed = invoices.keyed_notifications(lines)
    assert keyed.columns == ["key", "value"]
    assert rows_of(keyed, "value") == rows_of(invoices.notifications(lines))
    assert len(rows_of(keyed, "key")) == 2 and all(k.startswith("purchases-") for (k,) in rows_of(keyed, "key"))
