"""Work per key when one key may hold a large part of all rows.

``profile_keys`` counts rows per key (partial counts per task, so a hot key costs no
more than any other).  Heavy keys stay a table: joins leave their rows where they are,
running sums cut all rows into ranges as soon as one key is heavy.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeflow.plans.lineage import freeze

# A key above this many rows is split.
HEAVY_ROWS = 2_000_000
# Keys above 1/HEAVY_KEYS of all rows are heavy too, so there are at most that many heavy keys; any
# other key holds less than a task's share of the rows.
HEAVY_KEYS = 200_000
# A lookup side of at most this many (narrow) rows is sent to every executor.
BROADCAST_ROWS = 200_000
# Groups in which keys are counted before they are counted one by one.
BUCKETS = 1 << 17


@dataclass(frozen=True)
class KeyProfile:
    """Row counts of a key column, and its heavy keys as a table (None: there are none)."""

    key: str
    rows: int
    largest: int
    heavy_rows: int
    heavy: DataFrame | None = None

    def only_heavy(self, df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(self.heavy), self.key, "left_semi")

    def without_heavy(self, df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(self.heavy), self.key, "left_anti")


def profile_keys(df: DataFrame, key: str, heavy_rows: int = HEAVY_ROWS) -> KeyProfile:
    """Count rows per key, and again for the heavy keys if there are any.  Runs jobs."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    seen = counts.agg(F.sum("n").alias("rows"), F.max("n").alias("largest")).first()
    rows, largest = seen["rows"] or 0, seen["largest"] or 0
    heavy = None
    if largest > heavy_rows:
        heavy = freeze(counts.where(F.col("n") > max(heavy_rows, rows // HEAVY_KEYS)).select(key))
    return KeyProfile(key, rows, largest, heavy_rows, heavy)


def no_key_above(df: DataFrame, key: str, most: int) -> bool:
    """Whether no key has more than ``most`` rows.  Runs a job, and seldom a second one.

    Keys are counted in ``BUCKETS`` groups first, which fit a task's memory however many keys there are; no key has
    more rows than its group.  If a group is too large, keys are counted one by one.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS))
    groups = df.where(F.col(key).isNotNull()).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    largest = groups.agg(F.max("n")).first()[0] or 0
    return largest <= most or profile_keys(df, key, max(most, HEAVY_ROWS)).largest <= most


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_rows: int | None = None,
    profile: KeyProfile | None = None,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Inner join of many rows with a lookup holding one row per key.

    A lookup known to be short (``lookup_rows``) goes to every executor.  Otherwise
    the rows of heavy keys stay where they are and meet a broadcast of just their
    lookup rows (at most ``HEAVY_KEYS``), and all others are joined as Spark sees fit.
    """
    if lookup_rows is not None and lookup_rows <= BROADCAST_ROWS:
        return rows.join(F.broadcast(lookup), key)
    profile = profile or profile_keys(rows, key, heavy_rows)
    if profile.heavy is None:
        return rows.join(lookup, key)
    usual = profile.without_heavy(rows).join(lookup, key)
    hot = profile.only_heavy(rows).join(F.broadcast(profile.only_heavy(lookup)), key)
    return usual.unionByName(hot)


def running_before(
    df: DataFrame,
    value: str,
    order_by: list[str],
    profile: KeyProfile,
    out: str,
    until: str | None = None,
) -> DataFrame:
    """Add Σ ``value`` over the rows of the same key that come earlier in ``order_by``; rows without a key go.

    Without heavy keys this is one window over the key.  Otherwise all rows are cut into
    ordered ranges that fit a task each, however the rows are spread over keys.  Just the first
    and last key of a range can go on elsewhere, so two rows per range say where each starts.
    A row number is the last word in the order, so rows equal in ``order_by`` spread as well.

    ``until`` names a column of limits: rows whose earlier sum has reached it may be
    missing from the result.  With values above zero, ranges that start there are
    left out before they are sorted.
    """
    key = profile.key
    earlier = (Window.unboundedPreceding, -1)

    def before(column: str, *within: str, order: list[str]) -> Column:
        window = Window.partitionBy(*within).orderBy(*order).rowsBetween(*earlier)
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    df = df.where(F.col(key).isNotNull())
    if profile.largest <= profile.heavy_rows:
        return df.withColumn(out, before(value, key, order=order_by))

    # Ranges are found by sampling, so they are fixed on disk before being used twice.
    ranges = max(
        int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), ceil(profile.rows / profile.heavy_rows)
    )
    order = [*order_by, "_row"]
    cut = freeze(
        df.withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(ranges, key, *order)
        .withColumn("_range", F.spark_partition_id())
    )
    ends = (
        cut.groupBy("_range", key)
        .agg(F.sum(value).alias("_sum"))
        .groupBy("_range")
        .agg(F.min(F.struct(key, "_sum")).alias("first"), F.max(F.struct(key, "_sum")).alias("last"))
    )
    starts = (
        ends.select("_range", F.explode(F.array_distinct(F.array("first", "last"))).alias("end"))
        .select("_range", f"end.{key}", "end._sum")
        .withColumn("_start", before("_sum", key, order=["_range"]))
        .drop("_sum")
    )
    cut = cut.join(F.broadcast(starts), [key, "_range"], "left").withColumn(
        "_start", F.coalesce("_start", F.lit(0))
    )
    if until:
        cut = cut.where(F.col("_start") < F.col(until))
    summed = cut.withColumn(out, before(value, key, "_range", order=order) + F.col("_start"))
    return summed.select(*df.columns, out)
