from pyspark.sql import functions as F

from rows import at, money, plan_of, rows_of
from storeflow.functions import columns
from storeflow.operators import star
from storeflow.schemas import TABLES, empty

LINE = (
    "source_id string, line_no int, customer_id string, customer_name string, timestamp timestamp_ntz, "
    "product_id string, product_name string, quantity int, price decimal(15,2), total_price decimal(15,2)"
)


def lines(spark, rows):
    """(customer, product, seconds) tuples as sold lines."""
    full = [
        (f"M{i}", 0, c, f"customer {c}", None if s is None else at(s), p, f"name {p}", 2, money(3), money(6))
        for i, (c, p, s) in enumerate(rows)
    ]
    return spark.createDataFrame(full, LINE)


def test_one_name_per_key(spark):
    df = spark.createDataFrame(
        [("A1", "Pen"), ("A1", "Biro"), ("A1", "Pen"), ("A2", None), (None, "x")],
        "product_id string, product_name string",
    )
    assert rows_of(star.product_rows(df)) == {("A1", "Biro"), ("A2", None)}


def test_new_dimension_rows(spark):
    rows = spark.createDataFrame([("A", "a"), ("B", "b")], "product_id string, product_name string")
    dim = spark.createDataFrame([("B", "old"), ("C", "c")], "product_id string, product_name string")
    assert rows_of(star.new_dim_rows(rows, dim, "product_id")) == {("A", "a")}
    nothing = empty(spark, TABLES["product_dim"])
    assert rows_of(star.new_dim_rows(rows, nothing, "product_id")) == {("A", "a"), ("B", "b")}


def test_time_rows(spark):
    df = lines(spark, [("C", "A", 0), ("D", "B", 0), ("C", "A", 61), ("C", "A", None)])
    # 2025-03-01 was a Saturday.
    assert rows_of(star.time_rows(df).drop("id")) == {
        (at(0).date(), 2025, 3, 1, 9, 0, 0, 7),
        (at(0).date(), 2025, 3, 1, 9, 1, 1, 7),
    }


def test_time_key_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    seen = set()
    try:
        for z in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", z)
            df = spark.createDataFrame([("2025-03-09 02:30:00",)], "t string")
            timed = columns.with_event_time(df, "t")
            rows = star.time_rows(timed, "t").collect()
            seen.add((rows[0]["id"], rows[0]["hour"], rows[0]["minute"], str(rows[0]["date"])))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert seen == {(1741487400, 2, 30, "2025-03-09")}


def test_second_of_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2025-03-09 02:30:07.654321",)], "t string")
        cut = columns.with_event_time(df, "t").select(columns.second_of("t").alias("s"))
        assert cut.dtypes == [("s", "timestamp_ntz")]
        assert str(cut.collect()[0]["s"]) == "2025-03-09 02:30:07"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_time_key_before_1970(spark):
    df = spark.createDataFrame([("1969-12-31 23:59:59",)], "t string")
    assert columns.with_event_time(df, "t").select(columns.time_key("t")).collect()[0][0] == -1


def test_fact_has_each_lines_own_time(spark):
    df = lines(spark, [("C", "A", 0), ("C", "A99", 60), ("C", "A", None)])
    fact = star.sales_fact(df)
    assert fact.columns == TABLES["sales_fact"].fieldNames()
    first = rows_of(star.time_rows(df), "id", "minute")
    assert {k for k, _ in first} | {None} == {r[0] for r in rows_of(fact, "time_id")}
    assert fact.select("sale_id").distinct().count() == 3


def test_lookup_in_a_time_table_with_its_own_numbers(spark):
    df = lines(spark, [("C", "A", 0), ("C", "B", 61), ("C", "D", 500)])
    times = star.time_rows(df.where("product_id <> 'D'"))
    # The table repeats every second under a higher number.
    numbered = times.withColumn("id", F.col("minute").cast("bigint") + 1)
    doubled = numbered.unionByName(numbered.withColumn("id", F.col("id") + 10))
    assert rows_of(star.sales_fact(df, doubled), "product_id", "time_id") == {
        ("A", 1), ("B", 2), ("D", None)
    }


def test_labels(spark):
    df = spark.createDataFrame([(money("1234567.50"), money("8.3"))], "m decimal(25,2), p decimal(5,1)")
    got = df.select(columns.money_label("m"), columns.pct_label("p")).collect()[0]
    assert tuple(got) == ("1,234,568", "8.3%")


def test_sale_price_rounds_half_up(spark):
    df = spark.createDataFrame([(money("4.99"),), (money("10.49"),), (None,)], "c decimal(15,2)")
    assert rows_of(df.select(columns.sale_price("c"))) == {(money("5.99"),), (money("12.59"),), (None,)}


def test_new_dimension_rows_read_a_stretch_of_the_dimension_without_shuffling_it(spark, tmp_path):
    """A batch that fits every executor meets the dimension where it lies; rows beyond its keys are passed over."""
    days = spark.range(100_000).select(F.col("id"), (F.col("id") % 7).cast("int").alias("weekday"))
    days.repartitionByRange(8, "id").write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    rows = spark.createDataFrame([(5, 1), (99_999, 2), (100_003, 3)], "id bigint, weekday int")
    new = star.new_dim_rows(rows, dim, "id")
    assert rows_of(new) == {(100_003, 3)}
    # The part that reads the dimension: a scan of one column between two bounds, then a broadcast join.
    plan = new._jdf.queryExecution().optimizedPlan().toString()
    dim_side = plan.split("Join LeftAnti")[1].split("Join LeftSemi")[1]
    assert "Repartition" not in dim_side
    physical = plan_of(new)
    assert "GreaterThanOrEqual(id,5)" in physical and "LessThanOrEqual(id,100003)" in physical
    assert "ReadSchema: struct<id:bigint>" in physical
    scans = physical.split("Scan parquet")[1]
    assert "BroadcastHashJoin" in physical and "Exchange hashpartitioning" not in scans


def test_new_dimension_rows_of_nothing(spark):
    nothing = empty(spark, TABLES["product_dim"])
    assert star.new_dim_rows(nothing, nothing, "product_id").count() == 0


def test_sale_keys_are_exact(spark):
    fact = star.sales_fact(lines(spark, [("C", "A", 0), ("C", "A", 0)]))
    assert rows_of(fact, "sale_id") == {("M0-0",), ("M1-0",)}
