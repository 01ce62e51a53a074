"""A Merkle manifest of a table: checkpoint and recompute.

Rows are hashed to leaves, the leaves of a group are put in order and folded ``FAN`` at a time up to the group's
subroot; the subroots, in the order of their groups, are folded to the root in the same way.  Only every
``KEPT_EVERY``-th level is written.  A proof needs the siblings on all levels: the missing ones of an aligned subtree
are made anew from its stored nodes, given out as siblings, and forgotten with the subtree.

The texts are read once and never shuffled.  Ranks come from sorted ranges, so a group with a third of all rows
spreads over as many tasks as its rows ask for; a subtree holds at most ``FAN ** KEPT_EVERY`` nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby
from math import ceil
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from storeflow.llm.common import partitions, stored

FAN = 16
# Levels 0, 3, 6, ... are kept: subtrees of 4,096 nodes.
KEPT_EVERY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def framed(value: Column) -> Column:
    """``-`` for null, else byte count, colon, value: no two rows are framed alike."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[framed(f) for f in fields]).cast("binary"), 256)


def digest(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def fold(nodes: list[str], size: int, steps: int) -> tuple[list[list[str]], int]:
    """The levels above ``nodes``, a stretch of a level of ``size`` nodes, and the size of the last of them."""
    levels = [nodes]
    while size > 1 and len(levels) <= steps:
        nodes = [digest(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]
        size = ceil(size / FAN)
        levels.append(nodes)
    return levels, size


def ranked(df: DataFrame, keys: list[str], order: list[str], label: str) -> DataFrame:
    """Adds ``pos`` (from 0 in the order, per key) and ``size`` (rows of the key).

    Rows are cut into sorted ranges and written; a row's place in its range and how many rows of its key stand in
    earlier ranges give its rank.  No window ever sees more than a row per range and key.
    """
    by = [*keys, *order]
    placed = stored(
        df.repartitionByRange(partitions(df.sparkSession), *by)
        .sortWithinPartitions(*by)
        .withColumn("_place", F.monotonically_increasing_id()),
        label,
    )
    part = F.shiftright("_place", 33)
    runs = placed.groupBy(*keys, part.alias("_part")).agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        "_part",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("size"),
    )
    same = part == F.col("_part")
    for k in keys:
        same &= placed[k].eqNullSafe(F.col(f"_{k}"))
    return placed.join(runs, same).select(
        *df.columns, (F.col("_place") + F.col("_shift")).alias("pos"), "size"
    )


@dataclass(frozen=True)
class Forest:
    """Trees over ranked leaves: every ``every``-th level as (tree, pos, hash, size), size being the level's nodes."""

    levels: list[DataFrame]
    every: int

    def tops(self) -> DataFrame:
        """(tree, hash) of each tree's last node."""
        found = [level.where("size = 1").select("tree", "hash") for level in self.levels]
        return reduce(DataFrame.unionByName, found)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows of sorted batches by their first two columns, (tree, block)."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

    return groupby(rows(), key=itemgetter(0, 1))


def _emit(rows: Iterator[tuple], schema: pa.Schema, many: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema
        )

    for row in rows:
        held.append(row)
        if len(held) == many:
            yield batch()
            held = []
    if held:
        yield batch()


def _by_subtree(df: DataFrame, *order: str) -> DataFrame:
    """Rows of a subtree in one task, in order."""
    return df.repartition("tree", "block").sortWithinPartitions("tree", "block", *order)


_NODE = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("hash", pa.string()), ("size", pa.int64())])


def build_forest(leaves: DataFrame, largest: int, every: int = KEPT_EVERY, label: str = "level") -> Forest:
    """From level-0 nodes (tree, pos, hash, size) to the tops; ``largest`` is the largest tree's number of leaves."""

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tops() -> Iterator[tuple]:
            for (tree, block), found in _grouped(batches):
                rows = list(found)
                levels, size = fold([r[3] for r in rows], rows[0][4], every)
                yield tree, block, levels[-1][0], size

        return _emit(tops(), _NODE)

    levels, width = [leaves.select("tree", "pos", "hash", "size")], FAN**every
    while largest > 1:
        block = F.floor(F.col("pos") / width).alias("block")
        rows = levels[-1].where("size > 1").select("tree", block, "pos", "hash", "size")
        above = _by_subtree(rows, "pos").mapInArrow(up, "tree string, pos long, hash string, size long")
        levels.append(stored(above, label))
        largest = ceil(largest / width)
    return Forest(levels, every)


# A path is written as left|right;left|right..., level by level, and may end in # and a remark.
def _path_of(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    """Siblings to the left and right of node ``i`` on each level below the last."""
    out = []
    for level in levels[:-1]:
        run = i - i % FAN
        out.append(("".join(level[run:i]), "".join(level[i + 1 : run + FAN])))
        i //= FAN
    return out


def _join(path: list[tuple[str, str]], rest: str) -> str:
    own = ";".join([f"{left}|{right}" for left, right in path])
    return own + rest if not own or not rest or rest[0] == "#" else f"{own};{rest}"


def _split(path: str) -> tuple[list[tuple[str, ...]], str]:
    steps, _, remark = path.partition("#")
    return [tuple(step.split("|")) for step in steps.split(";")] if steps else [], remark


def climb(node: str, path: list[tuple[str, ...]]) -> str:
    """The root that a node and its siblings give."""
    for left, right in path:
        node = digest([left, node, right])
    return node


def _subtrees(nodes: DataFrame, above: DataFrame, width: int, carried: list[str]) -> DataFrame:
    """Nodes by subtree, led by one row with the path that all of them share from the subtree's top on."""

    def none(kind: str | T.DataType, name: str) -> Column:
        return F.lit(None).cast(kind).alias(name)

    rows = nodes.select(
        "tree", F.floor(F.col("pos") / width).alias("block"), "pos", "hash", "size", none("string", "path"), *carried
    )
    lead = above.select(
        "tree",
        F.col("pos").alias("block"),
        F.lit(-1).cast("long").alias("pos"),
        none("string", "hash"),
        none("long", "size"),
        "path",
        *[none(nodes.schema[c].dataType, c) for c in carried],
    )
    return _by_subtree(rows.unionByName(lead), "pos")


def _siblings(batches: Iterator[pa.RecordBatch], every: int) -> Iterator[tuple[list[tuple], str, Callable]]:
    """Per subtree: its rows, the path they share, and what gives a row's own siblings below that."""
    for _, found in _grouped(batches):
        shared = next(found)[5]
        rows = list(found)
        levels, _ = fold([r[3] for r in rows], rows[0][4], every)
        first = rows[0][2]
        yield rows, shared, lambda row, levels=levels, first=first: _path_of(levels, row[2] - first)


def paths(nodes: DataFrame, above: DataFrame, every: int, carried: tuple[str, ...] = ()) -> DataFrame:
    """(tree, pos, path, hash, ...): siblings of each node from its level to the root."""
    kept = [nodes.schema[c] for c in carried]
    fields = [("tree", T.StringType()), ("pos", T.LongType()), ("path", T.StringType()), ("hash", T.StringType())]
    out = T.StructType([*[T.StructField(*f) for f in fields], *kept])
    schema = to_arrow_schema(out)

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for rows, shared, siblings in _siblings(batches, every):
                for row in rows:
                    yield row[0], row[2], _join(siblings(row), shared), row[3], *row[6:]

        return _emit(found(), schema, 256)

    return _subtrees(nodes, above, FAN**every, list(carried)).mapInArrow(down, out)


def leading_paths(forest: Forest, top_paths: DataFrame) -> DataFrame:
    """(tree, pos, path) for every subtree of level 0, given the path (tree, path) of each tree's top."""
    above: DataFrame | None = None
    for k in reversed(range(len(forest.levels))):
        # A tree that ends on this level begins with the path of its top.
        ended = forest.levels[k].where("size = 1").select("tree", F.lit(0).cast("long").alias("pos"))
        led = ended.join(top_paths, "tree").select("tree", "pos", "path")
        if above is not None:
            led = paths(forest.levels[k + 1], above, forest.every).select("tree", "pos", "path").unionByName(led)
        above = led
    return above


@dataclass(frozen=True)
class Manifest:
    """What is stored: ranked leaves (tree, pos, hash, size, id, carried), kept levels, the tree of subroots, the root.

    A tree is named by its group: empty for null, else ``=`` and the group.
    """

    leaves: DataFrame
    groups: Forest
    top: Forest
    subroots: DataFrame
    root: str | None
    carried: list[str]


def build_manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "source",
    fields: tuple[str, ...] = FIELDS,
    carry: dict[str, Column] | None = None,
    every: int = KEPT_EVERY,
) -> Manifest:
    """Hash, order and fold a table.

    Leaves ascend by id within their group, null ids first; repeated ids follow in the order of their hashes, so the
    root does not depend on how rows are stored.  The null group comes first, others by their UTF-8 bytes.  Null
    fields are framed as ``-``, an empty text as ``0:``; very long texts are hashed like others.  An empty table has
    no root (None).  ``carry`` adds columns, computed from ``docs``, to the leaves; other columns are not looked at.
    """
    carry = carry or {}
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("tree"),
        F.col(id_col).cast("long").alias("id"),
        leaf_hash([F.col(f) for f in fields]).alias("hash"),
        *[value.alias(name) for name, value in carry.items()],
    )
    # Ranking reads its rows twice, to sample and to sort them: the texts are read before that.
    rows = stored(rows, "hashed")
    leaves = stored(ranked(rows, ["tree"], ["id", "hash"], "leaves"), "ranked")
    groups = build_forest(leaves, leaves.agg(F.max("size")).first()[0] or 0, every)
    subroots = stored(ranked(groups.tops(), [], ["tree"], "subroots").withColumnRenamed("tree", "name"), "subroots")
    subroots = subroots.withColumn("tree", F.lit(""))
    top = build_forest(subroots, subroots.agg(F.max("size")).first()[0] or 0, every, "top")
    root = top.tops().first()
    return Manifest(leaves, groups, top, subroots, root and root["hash"], ["id", *carry])


def proofs(manifest: Manifest, check: str | None = None) -> DataFrame:
    """One row per leaf: (id, carried columns, leaf, subroot, root, proof_sha256, folded_root, verified).

    ``proof_sha256`` is the hash of all siblings from the leaf to the root.  ``folded_root`` is what these siblings
    give with the carried hash ``check`` in the leaf's place, or with the leaf where that is null.
    """
    every, carried, root = manifest.groups.every, manifest.carried, manifest.root
    whole = manifest.top.tops().select("tree", F.lit("").alias("path"))
    tops = paths(manifest.subroots, leading_paths(manifest.top, whole), every, ("name",))
    tops = tops.select(F.col("name").alias("tree"), F.concat("path", F.lit("#"), "hash").alias("path"))
    out = T.StructType(
        [manifest.leaves.schema[c] for c in carried]
        + [T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
        + [T.StructField("verified", T.BooleanType())]
    )
    schema = to_arrow_schema(out)
    at = 6 + carried.index(check) if check else None

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for rows, shared, siblings in _siblings(batches, every):
                rest, subroot = _split(shared)
                tail = "".join([left + right for left, right in rest])
                # Leaves that are what they were all give the subtree's top, which is then climbed from once.
                known: dict[str, str] = {}
                for row in rows:
                    path, leaf = siblings(row), row[3]
                    node = climb((row[at] if at else None) or leaf, path)
                    if node not in known:
                        known[node] = climb(node, rest)
                    proof = digest([left + right for left, right in path] + [tail])
                    yield *row[6:], leaf, subroot, root, proof, known[node], known[node] == root

        return _emit(found(), schema, 1024)

    above = leading_paths(manifest.groups, tops)
    return _subtrees(manifest.leaves, above, FAN**every, carried).mapInArrow(prove, out)
