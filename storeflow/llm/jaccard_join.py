"""N-gram Jaccard join: rare-first prefix filtering, joined on prefix n-grams, verified once per pair.

1. N-grams that stand in one document only cannot be shared.  They are the rarest, so they come first in a document's
   order: if they fill its prefix, the document has no partner, and nothing else of it is kept.
2. Documents with equal sets fall together, whatever their number; one stands for all.  Rarity is then counted
   again among those.
3. Documents meet on the n-grams left in their prefixes.  A meeting of many would give the square of its size in
   pairs, but only groups of linked documents are asked for: first everyone there is compared with a
   few (``PIVOTS``); the groups found so far then have nothing left to compare within themselves, and
   only pairs across groups follow.  No pair that could join two groups is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeflow.llm.common import groups_for, id_and_text, stored
from storeflow.llm.components import components
from storeflow.llm.shingles import GROUP_BYTES, mixed, shared_of_sets, shared_of_texts

WIDTH = 3
PERCENT = 90
PIVOTS = 8
# Parts into which sets are cut by hash; a set has a bit for each, whether it holds an odd number of n-grams there.
PARITIES = 256


def _prefix(n: Column, shared: Column, percent: int) -> Column:
    """How many shared n-grams the prefix holds behind those of this document alone."""
    return n - F.ceil(n * percent / 100).cast("long") + 1 - (n - shared)


def _may_link(percent: int) -> Column:
    """Length, positional and suffix filters for a pair that meets at places ``pos`` of both prefixes."""
    need = F.ceil((F.col("a_n") + F.col("b_n")) * percent / (100 + percent))
    rest = F.least(F.col("a_n") - F.col("a_pos"), F.col("b_n") - F.col("b_pos"))
    # What stands before the place in one prefix may at best be common as well, unless no other document holds it.
    before = F.least(F.col("a_pos") - F.col("a_alone"), F.col("b_pos") - F.col("b_alone"))
    # Suffix filter: where the parities of a part of the sets differ, at least one n-gram is not common.
    apart = F.col("a_alone") + F.col("b_alone")
    for k in range(PARITIES // 64):
        apart += F.bit_count(F.col(f"a_p{k}").bitwiseXOR(F.col(f"b_p{k}")))
    return (
        (100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))
        & (before + rest >= need)
        & (apart <= F.col("a_n") + F.col("b_n") - 2 * need)
    )


def _postings(sets: DataFrame, percent: int) -> DataFrame:
    """(key, doc_id, n, alone, pos, p0, p1, ...) for the n-grams of prefixes.

    ``alone`` counts n-grams that no other document holds, ``p0``, ... are the parities of the others.
    """
    bits = [f"p{k}" for k in range(PARITIES // 64)]

    def parities(keys: bytes) -> np.ndarray:
        part = mixed(np.frombuffer(keys, "<u8")) % np.uint64(PARITIES)
        odd = np.bincount(part.astype(np.int64), minlength=PARITIES) & 1
        return np.packbits(odd.astype(np.uint8)).view("<i8")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, n, shared, prefix = (batch.column(k).to_numpy() for k in range(4))
            packed = batch.column(4).to_pylist()
            keys = [np.frombuffer(k, "<u8", p).view(np.int64) for k, p in zip(packed, prefix.tolist(), strict=True)]
            odd = np.array([parities(k) for k in packed], np.int64).reshape(-1, len(bits))
            places = [np.arange(p) + a for p, a in zip(prefix.tolist(), (n - shared).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([*keys, np.empty(0, np.int64)])),
                    pa.array(np.repeat(doc, prefix)),
                    pa.array(np.repeat(n, prefix)),
                    pa.array(np.repeat(n - shared, prefix)),
                    pa.array(np.concatenate([*places, np.empty(0, np.int64)]).astype(np.int64)),
                    *[pa.array(np.repeat(column, prefix)) for column in odd.T],
                ],
                ["key", "doc_id", "n", "alone", "pos", *bits],
            )

    prefix = F.least(_prefix(F.col("n"), F.col("shared"), percent), F.col("shared"))
    return sets.select("doc_id", "n", "shared", prefix.cast("long").alias("prefix"), "keys").mapInArrow(
        explode, ", ".join(f"{c} long" for c in ["key", "doc_id", "n", "alone", "pos", *bits])
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose sets are as similar as asked."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(6)]
            good = []
            for k, (n, m, x, y) in enumerate(zip(*columns[2:], strict=True)):
                need = -(-percent * (n + m) // (100 + percent))
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                # Suffix filter: cut by value, no part can share more than the smaller side holds.
                cuts = np.stack([np.bincount((z >> np.uint64(60)).astype(np.int64), minlength=16) for z in (x, y)])
                if cuts.min(axis=0).sum() < need:
                    continue
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (n + m - common):
                    good.append(k)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(good, pa.int32())),
                                              batch.column(1).take(pa.array(good, pa.int32()))], ["a", "b"])

    def side(name: str, short: str) -> DataFrame:
        return sets.select(F.col("doc_id").alias(name), F.col("n").alias(f"{name}_n"), F.col("keys").alias(short))

    return (
        pairs.join(side("a", "x"), "a")
        .join(side("b", "y"), "b")
        .select("a", "b", "a_n", "b_n", "x", "y")
        .mapInArrow(check, "a long, b long")
    )


def _sided(postings: DataFrame, side: str, *more: str) -> DataFrame:
    return postings.select(
        "key",
        F.col("doc_id").alias(side),
        F.col("n").alias(f"{side}_n"),
        *[F.col(c).alias(f"{side}_{c}") for c in postings.columns if c in ("alone", "pos") or c[0] == "p" and c[1:].isdigit()],
        *[F.col(c).alias(f"{side}_{c}") for c in more],
    )


def _pairs(met: DataFrame, percent: int) -> DataFrame:
    return (
        met.where("a != b")
        .where(_may_link(percent))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def links(sets: DataFrame, percent: int) -> DataFrame:
    """Enough pairs (a, b) of linked documents to hold each group of linked documents together."""
    postings = stored(_postings(sets, percent), "postings")
    # The documents least changed come first: copies of one text are nearest to those.
    central = Window.partitionBy("key").orderBy("alone", F.xxhash64("doc_id"), "doc_id")
    pivots = postings.withColumn("_r", F.row_number().over(central)).where(F.col("_r") <= PIVOTS).drop("_r")
    first = stored(_pairs(_sided(pivots, "a").join(_sided(postings, "b"), "key"), percent), "pairs")
    found = stored(_verified(first, sets, percent), "links")

    groups = components(found)
    placed = postings.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id")
    )
    placed = stored(placed, "placed")
    counts = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"))
    main = (
        counts.groupBy("key")
        .agg(F.max(F.struct("c", "component")).alias("top"), F.count(F.lit(1)).alias("groups"))
        .where("groups > 1")
        .select("key", F.col("top.component").alias("main"))
    )
    mixed = placed.join(main, "key")
    others = _sided(mixed.where("component != main"), "a", "component")
    everyone = _sided(mixed, "b", "component", "main")
    met = others.join(everyone, "key").where("a_component != b_component").where("b_component = b_main OR a < b")
    second = _pairs(met, percent).join(first, ["a", "b"], "left_anti")
    return found.unionByName(stored(_verified(second, sets, percent), "links"))


def jaccard_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per document: (doc_id, n_shingles, component_id).

    Words are lower-cased (A-Z).  Two documents are linked if ``100 * common >= percent * all`` of their distinct
    n-grams; ``component_id`` is the smallest id that can be reached.  Null, empty and blank texts have no n-gram and
    no link; texts of fewer words have their whole sequence as the only one; very long texts are taken whole.  Rows with
    one id are one document, linked with whatever any of their texts is linked with, and each get a row; rows with a
    null id match nothing and have a null component.  An empty table gives no rows; other columns are not looked at.
    """
    every = stored(shared_of_texts(id_and_text(docs, id_col, text_col), width, percent), "shared")
    able = (F.col("n") > 0) & (_prefix(F.col("n"), F.col("shared"), percent) > 0) & F.col("doc_id").isNotNull()
    # Documents of one set hold only shared n-grams; the others stand for themselves.
    digest = F.sha2("keys", 256)
    same = F.when(F.col("n") == F.col("shared"), digest).otherwise(F.concat_ws("|", "doc_id", "n", digest))
    living = every.where(able).withColumn("same", same)
    # A node per set: rows that share an id may have several.
    named = stored(
        living.groupBy("same")
        .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"))
        .withColumn("node", F.monotonically_increasing_id()),
        "equal",
    )
    nodes = living.select("doc_id", "same").distinct().join(named.select("same", "node"), "same")
    nodes = stored(nodes.select("doc_id", "node"), "nodes")
    again = shared_of_sets(
        named.select(F.col("node").alias("doc_id"), "n", "keys"), percent, groups_for(every, GROUP_BYTES)
    )
    sets = stored(again.where(able), "sets")
    of_id = nodes.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a != b")
    one_id = nodes.join(of_id.select("doc_id", "a"), "doc_id").where("node != a").select(F.col("node").alias("b"), "a")
    found = components(links(sets, percent).unionByName(one_id))
    placed = named.select("node", "rep").join(found, "node", "left").select(
        "node", "rep", F.coalesce("component", "node").alias("component")
    )
    placed = stored(placed, "placed")
    least = placed.groupBy("component").agg(F.min("rep").alias("least"))
    member = (
        nodes.join(placed.join(least, "component").select("node", "least"), "node")
        .groupBy("doc_id")
        .agg(F.min("least").alias("component"))
    )
    return (
        every.select("doc_id", F.col("n").alias("n_shingles"))
        .join(member, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )
