import random

import pytest
from pyspark.sql import functions as F

from rows import STOCK, at, money, movements, rows_of
from storeflow.operators import inventory
from storeflow.plans.lineage import freeze
from storeflow.schemas import TABLES, empty

ORDER = ["event_time", "source_id", "line_no"]


def stock(spark, rows):
    return spark.createDataFrame([(p, f"name {p}", q, money(c), 50) for p, q, c in rows], STOCK)


def no_stock(spark):
    return empty(spark, TABLES["inventory"]).drop("last_updated")


def quantities(df):
    return {r["product_id"]: r["quantity"] for r in df.collect()}


def test_restock_adds_inserts_and_keeps(spark):
    have = stock(spark, [("A", 5, "12.00"), ("B", 1, "3.00")])
    got = movements(spark, [("A", 0, "I1", 0, 4, 99), ("C", 0, "I1", 1, 7, 10)])
    assert rows_of(inventory.restock(have, got, ORDER)) == {
        ("A", "name A", 9, money(12), 50),
        ("B", "name B", 1, money(3), 50),
        ("C", "name C", 7, money(12), 50),
    }


def test_restock_of_an_empty_inventory(spark):
    got = movements(spark, [("A", 0, "I1", 0, 4, "10.49")])
    assert rows_of(inventory.restock(no_stock(spark), got, ORDER)) == {
        ("A", "name A", 4, money("12.59"), 50)
    }


def test_restock_with_a_product_twice_in_the_batch(spark):
    got = movements(spark, [("A", 5, "I2", 0, 4, 20), ("A", 5, "I1", 1, 3, 10)])
    assert rows_of(inventory.restock(no_stock(spark), got, ORDER)) == {
        ("A", "name A", 7, money(12), 50)
    }


def test_restock_keeps_the_first_price_and_name(spark):
    first = movements(spark, [("A", 0, "I1", 0, 1, 10)]).withColumn("product_name", F.lit("Pen"))
    second = movements(spark, [("A", 9, "I2", 0, 1, 20)]).withColumn("product_name", F.lit("Biro"))
    have = inventory.restock(no_stock(spark), first, ORDER)
    assert rows_of(inventory.restock(have, second, ORDER)) == {("A", "Pen", 2, money(12), 50)}


def test_sell_touches_only_stocked_products_and_may_go_negative(spark):
    have = stock(spark, [("A", 5, "12.00"), ("B", 1, "3.00")])
    gone = movements(spark, [("A", 0, "S1", 0, 4, 12), ("A", 0, "S1", 1, 4, 12), ("A99", 0, "S1", 2, 1, 1)])
    assert rows_of(inventory.sell(have, gone, ORDER)) == {("A", "name A", -3, money(12), 50)}


def test_sell_from_an_empty_inventory(spark):
    gone = movements(spark, [("A", 0, "S1", 0, 4, 12)])
    assert inventory.sell(no_stock(spark), gone, ORDER).count() == 0


def test_missing_price_and_level_are_filled(spark):
    have = spark.createDataFrame([("A", None, None, None, None)], STOCK)
    got = movements(spark, [("A", 0, "I1", 0, 4, 10)])
    assert rows_of(inventory.restock(have, got, ORDER)) == {("A", "name A", 4, money(12), 50)}
    assert rows_of(inventory.sell(have, got, ORDER)) == {("A", "name A", -4, money(12), 50)}


def test_latest_row_with_and_without_ties(spark):
    log = spark.createDataFrame(
        [("A", 1, at(0)), ("A", 2, at(9)), ("A", 3, at(9)), ("B", 7, at(1))],
        "product_id string, quantity int, last_updated timestamp_ntz",
    )
    keep = inventory.current_inventory(log, "keep")
    assert rows_of(keep, "product_id", "quantity") == {("A", 2), ("A", 3), ("B", 7)}
    one = inventory.current_inventory(log, "one")
    assert rows_of(one, "product_id", "quantity") == {("A", 3), ("B", 7)}
    with pytest.raises(ValueError):
        inventory.current_inventory(log, "some")


def test_stock_on_hand_edges(spark):
    moves = movements(
        spark,
        [
            ("A", 10, "I1", 0, 5, 10), ("A", 5, "S0", 0, -2, 12), ("A", 20, "S1", 0, -1, 12),
            ("A", 30, "I2", 0, 1, 99),
            ("B", 1, "S2", 0, -3, 1),
            ("C", 10, "I3", 0, 1, 5), ("C", 11, "S3", 0, -4, 6),
        ],
    )
    assert rows_of(inventory.stock_on_hand(moves, ORDER)) == {
        ("A", "name A", 5, money(12), 50),
        ("C", "name C", -3, money(6), 50),
    }


def test_stock_on_hand_of_sales_or_receipts_only(spark):
    assert inventory.stock_on_hand(movements(spark, [("A", 0, "S", 0, -1, 1)])).count() == 0
    assert quantities(inventory.stock_on_hand(movements(spark, [("A", 0, "I", 0, 2, 1)]))) == {"A": 2}
    assert inventory.stock_on_hand(movements(spark, [])).count() == 0


def test_reorder_levels(spark):
    moves = movements(spark, [("A", 0, "I", 0, 60, 1), ("B", 0, "I", 1, 60, 1), ("C", 0, "I", 2, 50, 1)])
    levels = spark.createDataFrame([("A", 200)], "product_id string, reorder_level int")
    have = inventory.stock_on_hand(moves, reorder_levels=levels)
    assert rows_of(have, "product_id", "reorder_level") == {("A", 200), ("B", 50), ("C", 50)}
    assert rows_of(inventory.low_stock(have), "product_id") == {("A",), ("C",)}


def test_guard_example(spark):
    asked = movements(spark, [("A", 0, "R1", 0, 3, 1), ("A", 1, "R2", 0, 4, 1), ("A", 2, "R3", 0, 1, 1)])
    have = stock(spark, [("A", 5, 1)])
    out = inventory.oversell_guard(asked, have, ORDER)
    assert rows_of(out, "source_id", "fulfilled") == {("R1", 3), ("R2", 2)}


def test_guard_without_stock(spark):
    asked = movements(spark, [("A", 0, "R1", 0, 3, 1), ("B", 0, "R2", 0, 3, 1)])
    out = inventory.oversell_guard(asked, stock(spark, [("A", -5, 1)]), ORDER)
    assert out.count() == 0


def day(rows, number):
    return [r for r in rows if r[1] // 100 == number]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_serial_merges_equal_the_ledger(spark, seed):
    """Batches merged one after the other give what the movements give at once."""
    rng = random.Random(seed)
    rows = [
        (f"P{rng.randrange(6)}", 100 * d + (0 if receipt else 50), f"{d}-{receipt}-{i}", 0,
         rng.randint(1, 9), rng.randint(1, 50))
        for d in range(3) for receipt in (True, False) for i in range(6)
    ]
    def receipt(r):
        return r[1] % 100 == 0

    have = no_stock(spark)
    for d in range(3):
        got = movements(spark, [r for r in day(rows, d) if receipt(r)])
        gone = movements(spark, [r for r in day(rows, d) if not receipt(r)])
        have = inventory.restock(have, got, ORDER)
        left = inventory.sell(have, gone, ORDER)
        rest = have.join(left.select("product_id"), "product_id", "left_anti")
        have = freeze(left.unionByName(rest))
    signed = [r if receipt(r) else (*r[:4], -r[4], r[5]) for r in rows]
    assert rows_of(have) == rows_of(inventory.stock_on_hand(movements(spark, signed), ORDER))


@pytest.mark.parametrize("cut", [0, 1, 2, 3])
def test_roll_forward_equals_the_whole_ledger(spark, cut):
    rng = random.Random(cut)
    rows = [
        (f"P{rng.randrange(8)}", rng.randrange(300), f"S{i}", 0,
         rng.choice([-1, 1]) * rng.randint(1, 9), rng.randint(1, 50))
        for i in range(60)
    ]
    old = movements(spark, [r for r in rows if r[1] < 100 * cut])
    new = movements(spark, [r for r in rows if r[1] >= 100 * cut])
    rolled = inventory.roll_forward(inventory.stock_on_hand(old, ORDER), new, ORDER)
    assert rows_of(rolled) == rows_of(inventory.stock_on_hand(movements(spark, rows), ORDER))


def test_kind_says_what_a_movement_is(spark):
    """A return is no receipt, a receipt of 0 units is one, a sale without a time counts."""
    moves = movements(
        spark, [("A", 5, "I", 0, 20, 10), ("A", 0, "S1", 0, 2, 99), ("A", 6, "S2", 0, -3, 12), ("B", 5, "I", 1, 0, 1)]
    )
    moves = moves.withColumn("kind", F.when(F.col("source_id") == "I", "receipt").otherwise("sale"))
    moves = moves.withColumn("event_time", F.when(F.col("source_id") != "S2", F.col("event_time")))
    assert rows_of(inventory.stock_on_hand(moves), "product_id", "quantity", "sale_prices") == {
        ("A", 17, money(12)), ("B", 0, money("1.2"))
    }
