"""Stock: latest snapshot rows, restock and sale merges, the movement ledger.

Stock is never rewritten in place.  Receipts and sales are signed movements, so
two writers cannot lose each other's updates, and what is on hand follows from
the movements: everything received, less what was sold from the first receipt
on, priced by the first receipt's cost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeflow.functions.columns import DEFAULT_REORDER_LEVEL, sale_price
from storeflow.plans.lineage import freeze
from storeflow.plans.skew import (
    HEAVY_ROWS,
    KeyProfile,
    lookup_join,
    profile_keys,
    running_before,
)

# Order in which movements of one product happened.
MOVEMENT_ORDER = ["event_time", "source_id", "line_no"]

# Kinds of movement.
RECEIPT, SALE = "receipt", "sale"

STOCK_COLUMNS = ["product_id", "product_name", "quantity", "sale_prices", "reorder_level"]


def current_inventory(
    inventory: DataFrame,
    ties: str = "keep",
    tie_break: list[str] | None = None,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Newest snapshot row per product.

    ``ties="keep"`` returns every row that shares the newest time; ``"one"`` picks
    one of them, the largest by ``tie_break`` (default: the other columns).  Both
    drop all but the leading rows of each task before the shuffle.
    """
    inventory = inventory.where("product_id IS NOT NULL AND last_updated IS NOT NULL")
    if ties == "keep":
        return _newest_with_ties(inventory, heavy_rows)
    if ties != "one":
        raise ValueError("ties must be 'keep' or 'one'")
    rest = [c for c in inventory.columns if c not in ("product_id", "last_updated")]
    order = [F.desc(c) for c in tie_break or rest]
    place = F.row_number().over(Window.partitionBy("product_id").orderBy(F.desc("last_updated"), *order))
    return inventory.withColumn("_place", place).where("_place = 1").drop("_place")


def _newest_with_ties(inventory: DataFrame, heavy_rows: int) -> DataFrame:
    """Rows at their product's newest time.

    Nothing bounds how many rows share that time, so the rows of heavy products are
    compared with a broadcast of their newest times and never gathered.
    """

    def leading(rows: DataFrame) -> DataFrame:
        place = F.rank().over(Window.partitionBy("product_id").orderBy(F.desc("last_updated")))
        return rows.withColumn("_place", place).where("_place = 1").drop("_place")

    profile = profile_keys(inventory, "product_id", heavy_rows)
    if profile.heavy is None:
        return leading(inventory)
    hot = profile.only_heavy(inventory)
    newest = hot.groupBy("product_id").agg(F.max("last_updated").alias("last_updated"))
    hot = hot.join(F.broadcast(newest), ["product_id", "last_updated"], "left_semi")
    return leading(profile.without_heavy(inventory)).unionByName(hot)


def _name_of(lines: DataFrame) -> Column:
    """The lines' product name, or null where they carry only ids; see :func:`named`."""
    name = F.col("product_name") if "product_name" in lines.columns else F.lit(None).cast("string")
    return name.alias("first_name")


def _first_price() -> Column:
    return F.col("price").alias("first_price")


def named(stock: DataFrame, product_dim: DataFrame) -> DataFrame:
    """Fill missing product names from the product dimension."""
    names = product_dim.select("product_id", F.col("product_name").alias("_name"))
    return (
        stock.join(names, "product_id", "left")
        .withColumn("product_name", F.coalesce("product_name", "_name"))
        .drop("_name")
    )


def _per_product(items: DataFrame, order_by: list[str]) -> DataFrame:
    """Batch lines folded per product: units, and the first line's name and price."""
    first = F.min(F.struct(*order_by, _name_of(items), _first_price()))
    return items.groupBy("product_id").agg(
        F.sum("quantity").alias("units"), first.alias("first")
    ).select(
        "product_id",
        "units",
        F.col("first.first_name").alias("item_name"),
        F.col("first.first_price").alias("item_price"),
    )


def _merged(quantity: Column) -> list[Column]:
    return [
        F.col("product_id"),
        F.coalesce("product_name", "item_name").alias("product_name"),
        quantity.alias("quantity"),
        F.coalesce("sale_prices", sale_price("item_price")).alias("sale_prices"),
        F.coalesce("reorder_level", F.lit(DEFAULT_REORDER_LEVEL)).alias("reorder_level"),
    ]


def _units(column: str) -> Column:
    return F.coalesce(F.col(column).cast("bigint"), F.lit(0).cast("bigint"))


def restock(inventory: DataFrame, items: DataFrame, order_by: list[str]) -> DataFrame:
    """Add received items to the current stock; products new to it are inserted.

    The first known name and price stay.  An empty inventory needs no case of its own.
    """
    merged = inventory.join(_per_product(items, order_by), "product_id", "full_outer")
    return merged.select(*_merged(_units("quantity") + _units("units")))


def sell(inventory: DataFrame, items: DataFrame, order_by: list[str]) -> DataFrame:
    """Take sold items off the current stock: the products that were sold, with what is left.

    Sales of products that were never stocked have no effect; stock may go below zero.
    """
    merged = inventory.join(_per_product(items, order_by), "product_id", "inner")
    return merged.select(*_merged(_units("quantity") - _units("units")))


def receipts(lines: DataFrame) -> DataFrame:
    """Import lines as incoming movements."""
    return lines.select(
        "product_id",
        "product_name",
        F.col("delivery_hour").alias("event_time"),
        F.col("import_id").alias("source_id"),
        "line_no",
        "quantity",
        "price",
        F.lit(RECEIPT).alias("kind"),
    )


def withdrawals(lines: DataFrame) -> DataFrame:
    """Purchase lines as outgoing movements."""
    return lines.select(
        "product_id",
        "product_name",
        F.col("timestamp").alias("event_time"),
        "source_id",
        "line_no",
        (-F.col("quantity")).alias("quantity"),
        "price",
        F.lit(SALE).alias("kind"),
    )


def _is_receipt(movements: DataFrame) -> Column:
    """By ``kind``, so a customer's return is no receipt and a receipt of 0 units is one; by sign without it."""
    return F.col("kind") == RECEIPT if "kind" in movements.columns else F.col("quantity") > 0


def opening_order(order_by: list[str] = MOVEMENT_ORDER) -> list[str]:
    """Fields of an ``opening``: the place of a product's first receipt, those without a time last."""
    return ["untimed", *order_by]


def _place(order_by: list[str], *more: Column) -> Column:
    return F.struct(F.isnull(order_by[0]).alias("untimed"), *order_by, *more)


def _counts(order_by: list[str]) -> Column:
    """A sale counts from the product's ``opening`` on, or if it carries no time."""
    opened = F.struct(*[F.col(f"opening.{c}").alias(c) for c in order_by])
    return F.isnull(order_by[0]) | (F.struct(*order_by) >= opened)


def stock_on_hand(
    movements: DataFrame,
    order_by: list[str] = MOVEMENT_ORDER,
    reorder_levels: DataFrame | None = None,
    heavy_rows: int = HEAVY_ROWS,
    with_opening: bool = False,
) -> DataFrame:
    """Stock per product from signed movements.

    A product exists from its first receipt; that receipt fixes name and price, and
    sales before it do not count.  Sales without a readable time count as after it, receipts without
    one come last.  ``reorder_levels`` (product_id, reorder_level)
    overrides the default level.  ``with_opening`` adds the place of the first receipt, which
    :func:`roll_forward` needs.

    Receipts are folded without a join and kept, one row per product: they are both
    the lookup that says which sales count and one side of the result.
    """
    incoming = freeze(
        movements.where(_is_receipt(movements))
        .groupBy("product_id")
        .agg(
            F.sum("quantity").alias("received"),
            F.min(_place(order_by, _first_price(), _name_of(movements))).alias("first"),
        )
    )
    opening = F.struct(*[F.col(f"first.{c}").alias(c) for c in opening_order(order_by)]).alias("opening")
    columns = dict.fromkeys(["product_id", *order_by, "quantity"])
    outgoing = movements.where(~_is_receipt(movements)).select(*columns)
    opened = incoming.select("product_id", opening)
    sold = (
        lookup_join(outgoing, opened, "product_id", incoming.count(), heavy_rows=heavy_rows)
        .where(_counts(order_by))
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("sold"))
    )
    stock = incoming.join(sold, "product_id", "left")
    level = F.lit(DEFAULT_REORDER_LEVEL)
    if reorder_levels is not None:
        stock = stock.join(reorder_levels, "product_id", "left")
        level = F.coalesce("reorder_level", level)
    return stock.select(
        "product_id",
        F.col("first.first_name").alias("product_name"),
        (F.col("received") + F.coalesce("sold", F.lit(0))).alias("quantity"),
        sale_price("first.first_price").alias("sale_prices"),
        level.cast("int").alias("reorder_level"),
        *([opening] if with_opening else []),
    )


def roll_forward(
    inventory: DataFrame,
    movements: DataFrame,
    order_by: list[str] = MOVEMENT_ORDER,
    history: DataFrame | None = None,
    reorder_levels: DataFrame | None = None,
    openings: DataFrame | None = None,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Stock after ``inventory`` and the movements that followed it.

    Products in the snapshot keep name and price; ``reorder_levels`` overrides their level.  Others follow
    :func:`stock_on_hand` over what ``history`` (all movements up to now, the new ones included)
    holds of just those products, so a sale that came before its product's import is not lost.  Without
    products new to the snapshot the join below finds nothing to look for.

    With ``openings`` (product_id, opening), as the snapshot's products were opened, the result is what
    :func:`stock_on_hand` gives over all movements, in whatever order they arrived: a sale dated before its
    product's opening is left out, and a receipt dated before it reopens that product from ``history``.  The result
    then has an ``opening`` column.  Without them a known product takes every movement.
    """
    known = inventory.select(*STOCK_COLUMNS)
    received = movements.where(_is_receipt(movements))
    firsts = received.groupBy("product_id").agg(F.min(_place(order_by)).alias("_first"))
    columns = [*STOCK_COLUMNS]
    if openings is None:
        taken = movements
        fresh = firsts.join(known.select("product_id"), "product_id", "left_anti").select("product_id")
    else:
        known = known.join(openings, "product_id", "left")
        columns.append("opening")
        # New to the snapshot, or received earlier than the snapshot knew.
        stocked = known.select("product_id", "opening", F.lit(True).alias("_known"))
        late = F.col("_known").isNull() | (F.col("_first") < F.col("opening"))
        fresh = firsts.join(stocked, "product_id", "left").where(late).select("product_id")
        needed = dict.fromkeys(["product_id", *order_by, "quantity"])
        sales = movements.where(~_is_receipt(movements)).select(*needed)
        # A snapshot's products without an opening take all their sales.
        counted = lookup_join(sales, known.select("product_id", "opening"), "product_id", heavy_rows=heavy_rows)
        counted = counted.where(F.isnull("opening") | _counts(order_by))
        taken = received.select("product_id", "quantity").unionByName(counted.select("product_id", "quantity"))
    fresh = freeze(fresh.distinct())
    moved = taken.groupBy("product_id").agg(F.sum("quantity").alias("units"))
    carried = known.join(fresh, "product_id", "left_anti") if openings is not None else known
    carried = carried.join(moved, "product_id", "left").withColumn(
        "quantity", F.col("quantity") + F.coalesce("units", F.lit(0))
    )
    if reorder_levels is not None:
        levels = reorder_levels.select("product_id", F.col("reorder_level").alias("_level"))
        carried = carried.join(levels, "product_id", "left").withColumn(
            "reorder_level", F.coalesce("_level", "reorder_level").cast("int")
        )
    of_fresh = (movements if history is None else history).join(fresh, "product_id", "left_semi")
    opened = stock_on_hand(of_fresh, order_by, reorder_levels, heavy_rows, with_opening=openings is not None)
    return carried.select(*columns).unionByName(opened.select(*columns))


def low_stock(stock: DataFrame) -> DataFrame:
    """Products at or below their reorder level."""
    return stock.where(F.col("quantity") <= F.col("reorder_level"))


def oversell_guard(
    requests: DataFrame,
    stock: DataFrame,
    order_by: list[str],
    profile: KeyProfile | None = None,
    heavy_rows: int = HEAVY_ROWS,
    reserved: DataFrame | None = None,
) -> DataFrame:
    """First come, first served against a stock snapshot of one row per product.

    Each request gets ``fulfilled`` = what it asked for or what is left; requests
    that get nothing, or ask for products not in stock, are dropped.  ``reserved`` (product_id, reserved),
    one row per product, is what earlier requests have been granted of that stock.
    """
    if reserved is not None:
        taken = reserved.select("product_id", F.col("reserved").alias("_reserved"))
        stock = stock.join(taken, "product_id", "left").withColumn(
            "quantity", F.col("quantity") - F.coalesce("_reserved", F.lit(0))
        )
    asked = requests.where("quantity > 0")
    profile = profile or profile_keys(asked, "product_id", heavy_rows)
    available = stock.where("quantity > 0").select("product_id", F.col("quantity").alias("available"))
    stocked = lookup_join(asked, available, "product_id", profile=profile)
    queued = running_before(stocked, "quantity", order_by, profile, "queued_before", "available")
    left = F.greatest(F.col("available") - F.col("queued_before"), F.lit(0))
    return (
        queued.withColumn("fulfilled", F.least(F.col("quantity"), left))
        .where("fulfilled > 0")
        .drop("available", "queued_before")
    )
