from rows import money, rows_of
from storeflow.operators import audit
from storeflow.plans import reports

FACT = "product_id string, customer_id string, time_id bigint, quantity int, total_amount decimal(15,2)"


def fact(spark, rows):
    return spark.createDataFrame([(p, c, t, q, money(a)) for p, c, t, q, a in rows], FACT)


def names(spark, rows, what):
    return spark.createDataFrame(rows, f"{what}_id string, {what}_name string")


def test_products_of_one_name_are_one_row(spark):
    f = fact(spark, [("A", "c", 0, 2, 5), ("B", "c", 0, 3, 1), ("D", "c", 0, 4, 9), ("ZZ", "c", 0, 9, 9)])
    dim = names(spark, [("A", "pen"), ("B", "pen"), ("D", "ink"), ("E", "unsold")], "product")
    assert [tuple(r) for r in reports.units_by_product(f, dim).collect()] == [("pen", 5), ("ink", 4)]
    assert [tuple(r) for r in reports.top_products(f, dim, 1).collect()] == [("pen", 5)]
    assert [tuple(r) for r in reports.revenue_by_product(f, dim).collect()] == [
        ("ink", money(9)), ("pen", money(6))
    ]


def test_ties_are_ordered_by_name(spark):
    f = fact(spark, [("A", "c", 0, 1, 1), ("B", "c", 0, 1, 1)])
    dim = names(spark, [("A", "z"), ("B", "a")], "product")
    assert [r[0] for r in reports.units_by_product(f, dim).collect()] == ["a", "z"]


def test_minutes_newest_hour_first(spark):
    times = spark.createDataFrame(
        [(1, 2025, 1, 1, 9, 5, 1), (2, 2025, 1, 1, 9, 5, 30), (3, 2025, 1, 1, 9, 7, 0), (4, 2025, 1, 1, 10, 0, 0)],
        "id bigint, year int, month int, day int, hour int, minute int, second int",
    )
    f = fact(spark, [("A", "c", 1, 1, 2), ("A", "c", 2, 2, 3), ("A", "c", 3, 1, 1), ("A", "c", 4, 1, 7), ("A", "c", None, 1, 1)])
    got = [tuple(r)[3:] for r in reports.revenue_by_minute(f, times).collect()]
    assert got == [(10, 0, money(7), 1), (9, 5, money(5), 3), (9, 7, money(1), 1)]


def test_shares(spark):
    f = fact(spark, [("A", "c1", 0, 1, 1), ("A", "c2", 0, 1, 2)])
    spent = reports.spend_by_customer(f, names(spark, [("c1", "ann"), ("c2", "bob")], "customer"))
    assert rows_of(reports.share(spent, "total_spent"), "customer_name", "pct_label") == {
        ("ann", "33.3%"), ("bob", "66.7%")
    }


def test_share_of_nothing(spark):
    f = fact(spark, [("A", "c1", 0, 1, 0)])
    spent = reports.spend_by_customer(f, names(spark, [("c1", "ann")], "customer"))
    assert rows_of(reports.share(spent, "total_spent"), "pct") == {(None,)}


def test_line_amounts(spark):
    df = spark.createDataFrame(
        [(2, money("1.5"), money(3)), (2, money("1.5"), money(4)), (None, money(1), money(1))],
        "quantity int, price decimal(15,2), total_amount decimal(15,2)",
    )
    assert rows_of(audit.line_amount_check(df), "total_amount", "amount_ok") == {
        (money(3), True), (money(4), False), (money(1), None)
    }


def test_invoice_totals(spark):
    headers = spark.createDataFrame(
        [("I1", money(3)), ("I2", money(9))], "import_id string, total_invoice_amount decimal(15,2)"
    )
    items = spark.createDataFrame(
        [("I1", money(1)), ("I1", money(2)), ("I2", money(8))], "import_id string, total_amount decimal(15,2)"
    )
    out = audit.invoice_total_check(headers, items)
    assert rows_of(out, "import_id", "total_ok") == {("I1", True), ("I2", False)}


def test_key_reference_and_null_audits(spark):
    child = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 2)], "k string, v int")
    parent = spark.createDataFrame([("b",), ("c",)], "k string")
    assert rows_of(audit.duplicate_keys(child, ["k", "v"])) == {("a", 1, 2)}
    assert rows_of(audit.orphans(child, parent, "k")) == {("a", 2)}
    assert rows_of(audit.null_counts(child)) == {("k", 1), ("v", 1)}
