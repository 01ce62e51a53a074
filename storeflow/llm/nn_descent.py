"""Approximate nearest neighbours: NN-descent, then greedy search of the graph.

Nearness is the inner product.  Equal vectors are one node of the graph.  A further component makes all nodes equally long,
so that near means the same to everyone (a query's further component is 0 and changes nothing).

The graph begins with neighbours along a few random projections: rows are sorted by projection and
compared in chunks of fixed size, so no cell can be crowded.  Each round joins nodes with their neighbours' neighbours: at
every node its neighbours, in both directions, are compared with each other, and what is nearer than what a node has so
far is sent to it.  Queries start at their own node and expand their best
unexpanded nodes, a few at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storeflow.llm.common import partitions, stored

TOP = 20
DEGREE = 40  # neighbours kept per node
REVERSE = 40  # reverse neighbours that take part in a round
ROUNDS = 7
PROJECTIONS = 4
SIGNS = 6
CHUNK = 256
BEAM = 240  # nodes a query remembers
EXPAND = 96  # nodes a query expands in a round
SEARCH_ROUNDS = 5
SENT = 16  # improvements that a bucket sends to one node in a round
BUCKET_NODES = 5_000
SEED = 5


def valid_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v) without null ids and null or zero vectors, nulls and non-finite numbers."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return (
        df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
        .where("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
        .where(F.coalesce(finite, F.lit(False)))
        .where(F.exists("v", lambda x: x != 0))
    )


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f4").reshape(-1, width)


def _best(owner: np.ndarray, other: np.ndarray, sim: np.ndarray, most: int) -> np.ndarray:
    """Rows of the ``most`` best of each owner, without repetition, best first."""
    order = np.lexsort((-sim, other, owner))
    o, t = owner[order], other[order]
    order = order[np.concatenate([[True], (o[1:] != o[:-1]) | (t[1:] != t[:-1])])] if len(order) else order
    order = order[np.lexsort((other[order], -sim[order], owner[order]))]
    o = owner[order]
    begins = np.flatnonzero(np.concatenate([[True], o[1:] != o[:-1]])) if len(o) else np.empty(0, np.int64)
    rank = np.arange(len(o)) - np.repeat(begins, np.diff(begins, append=len(o)))
    return order[rank < most]


def _bucket(column: str, deal: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(deal)).cast("long").alias("bucket")


def _deliver(pairs: DataFrame, nodes: DataFrame, deal: int) -> DataFrame:
    """(bucket, other, owners, x) for pairs (owner, other): a vector goes once to each bucket of owners."""
    return (
        pairs.groupBy(_bucket("owner", deal), "other")
        .agg(F.collect_set("owner").alias("owners"))
        .join(nodes.select(F.col("node").alias("other"), "x"), "other")
    )


def _first_neighbours(nodes: DataFrame, width: int, degree: int) -> DataFrame:
    """(owner, other, sim) along random projections."""
    spark, found, count = nodes.sparkSession, None, nodes.count()
    for r in range(PROJECTIONS):
        rng = np.random.default_rng(SEED + r)
        planes = rng.standard_normal((width, SIGNS + 1)).astype("<f4")

        def project(batches: Iterator[pa.RecordBatch], planes: np.ndarray = planes) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<f4").reshape(-1, width)
                y = x @ planes
                cell = ((y[:, :-1] > 0) * (1 << np.arange(SIGNS))).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell.astype(np.int64)), pa.array(y[:, -1].astype(np.float64))],
                    ["node", "x", "cell", "along"],
                )

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, rows = np.empty(0, np.int64), np.empty((0, width), "<f4")

            def near(i: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
                sims = x @ x.T
                np.fill_diagonal(sims, -np.inf)
                k = min(degree, len(i) - 1)
                at = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k > 0 else np.empty((len(i), 0), np.int64)
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(i, at.shape[1])),
                        pa.array(i[at].ravel()),
                        pa.array(np.take_along_axis(sims, at, 1).ravel().astype("<f4")),
                    ],
                    ["owner", "other", "sim"],
                )

            for batch in batches:
                ids = np.concatenate([ids, batch.column(0).to_numpy()])
                rows = np.concatenate(
                    [rows, np.frombuffer(b"".join(batch.column(1).to_pylist()), "<f4").reshape(-1, width)]
                )
                while len(ids) >= 2 * CHUNK:
                    yield near(ids[:CHUNK], rows[:CHUNK])
                    ids, rows = ids[CHUNK:], rows[CHUNK:]
            if len(ids):
                yield near(ids, rows)

        # Few partitions of many chunks: the last chunk of each takes the rest.
        parts = max(1, min(partitions(spark), count // (8 * CHUNK)))
        near_ones = (
            nodes.select("node", "x")
            .mapInArrow(project, "node long, x binary, cell long, along double")
            .repartitionByRange(parts, "cell", "along")
            .sortWithinPartitions("cell", "along")
            .select("node", "x")
            .mapInArrow(compare, "owner long, other long, sim float")
        )
        found = near_ones if found is None else found.unionByName(near_ones)
    return found


def _graph(edges: DataFrame, deal: int, degree: int) -> DataFrame:
    """(owner, others, worst): the best ``degree`` of each owner and the last one's nearness."""

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        owner, other, sim = (group[c].to_numpy() for c in ("owner", "other", "sim"))
        best = _best(owner, other, sim, degree)
        owner, other, sim = owner[best], other[best], sim[best]
        names, begins = np.unique(owner, return_index=True)
        ends = np.append(begins[1:], len(owner))
        worst = np.where(ends - begins < degree, -np.inf, sim[np.maximum(ends - 1, 0)] if len(sim) else 0)
        return pd.DataFrame(
            {
                "owner": names,
                "others": [other[a:b] for a, b in zip(begins, ends, strict=True)],
                "sims": [sim[a:b] for a, b in zip(begins, ends, strict=True)],
                "worst": worst.astype("f4"),
            }
        )

    dealt = edges.select(_bucket("owner", deal), "owner", "other", "sim")
    return dealt.groupBy("bucket").applyInPandas(
        merge, "owner long, others array<long>, sims array<float>, worst float"
    )


def _flat(graph: DataFrame) -> DataFrame:
    both = F.explode(F.arrays_zip("others", "sims")).alias("e")
    return graph.select("owner", both).select("owner", F.col("e.others").alias("other"), F.col("e.sims").alias("sim"))


def build_graph(nodes: DataFrame, width: int, deal: int, degree: int = DEGREE, rounds: int = ROUNDS) -> DataFrame:
    """(owner, others, sims, worst) after ``rounds`` rounds of NN-descent over (node, x)."""
    graph = stored(_graph(_first_neighbours(nodes, width, degree), deal, degree), "graph")
    for _ in range(rounds):
        edges = _flat(graph)
        nearest = Window.partitionBy("owner").orderBy(F.desc("sim"), "other")
        back = (
            edges.select(F.col("other").alias("owner"), F.col("owner").alias("other"), "sim")
            .withColumn("_r", F.row_number().over(nearest))
            .where(F.col("_r") <= REVERSE)
        )
        pairs = edges.select("owner", "other").unionByName(back.select("owner", "other"))
        known = nodes.join(graph.select(F.col("owner").alias("node"), "worst"), "node", "left")
        sent = _deliver(pairs, known.select("node", F.struct("x", "worst").alias("x")), deal)
        sent = sent.select("bucket", "other", "owners", "x.x", "x.worst")

        def local(group: pd.DataFrame) -> pd.DataFrame:
            x = _matrix(group["x"], width)
            ids, worst = group["other"].to_numpy(), group["worst"].fillna(-np.inf).to_numpy("f4")
            lengths = np.array([len(o) for o in group["owners"]], np.int64)
            owner = np.concatenate([np.asarray(o, np.int64) for o in group["owners"]])
            row = np.repeat(np.arange(len(ids)), lengths)
            order = np.argsort(owner, kind="stable")
            cuts = np.flatnonzero(np.diff(owner[order])) + 1
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for members in np.split(row[order], cuts):
                sims = x[members] @ x[members].T
                np.fill_diagonal(sims, -np.inf)
                k = min(8, len(members))
                at = np.argpartition(-sims, k - 1, axis=1)[:, :k]
                top = np.take_along_axis(sims, at, 1)
                good = top > worst[members][:, None]
                one, two = np.nonzero(good)
                out.append((members[one], members[at[one, two]], top[good]))
            a, b, s = (np.concatenate(c) for c in zip(*out, strict=True))
            best = _best(a, b, s.astype("f4"), SENT)
            return pd.DataFrame({"owner": ids[a[best]], "other": ids[b[best]], "sim": s[best].astype("f4")})

        better = sent.groupBy("bucket").applyInPandas(local, "owner long, other long, sim float")
        graph = stored(_graph(edges.unionByName(better), deal, degree), "graph")
    return graph


def search(queries: DataFrame, nodes: DataFrame, graph: DataFrame, width: int, deal: int) -> DataFrame:
    """(q, node) for the nodes that queries (q, start, y) remember after a greedy search."""
    state = queries.select(
        _bucket("q", deal), "q", "y",
        F.array("start").alias("seen"), F.array(F.lit(float("inf")).cast("float")).alias("sims"),
        F.array(F.lit(False)).alias("done"),
    )
    for _ in range(SEARCH_ROUNDS):
        state = stored(state, "search")
        open_ = F.slice(F.filter(F.arrays_zip("seen", "done"), lambda e: ~e["done"]), 1, EXPAND)
        front = state.select("q", F.explode(F.transform(open_, lambda e: e["seen"])).alias("owner"))
        pairs = front.join(graph, "owner").select(F.col("q").alias("owner"), F.explode("others").alias("other"))
        sent = _deliver(pairs, nodes, deal)

        def step(mine: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
            names = ["bucket", "q", "y", "seen", "sims", "done"]
            if not len(mine):
                return pd.DataFrame({n: [] for n in names})
            place = {q: k for k, q in enumerate(mine["q"].tolist())}
            done = []
            for flags in mine["done"]:
                flags = np.array(flags, bool)
                flags[np.flatnonzero(~flags)[:EXPAND]] = True
                done.append(flags)
            owner = [np.repeat(np.arange(len(mine)), [len(s) for s in mine["seen"]])]
            other = [np.concatenate([np.asarray(s, np.int64) for s in mine["seen"]])]
            sim = [np.concatenate([np.asarray(s, "f4") for s in mine["sims"]])]
            flag = [np.concatenate(done)]
            if len(sent):
                x, y = _matrix(sent["x"], width), _matrix(mine["y"], width)
                row = np.repeat(np.arange(len(sent)), [len(o) for o in sent["owners"]])
                q = np.array([place[o] for some in sent["owners"] for o in some], np.int64)
                for at in range(0, len(q), 100_000):
                    part = slice(at, at + 100_000)
                    sim.append(np.einsum("ij,ij->i", x[row[part]], y[q[part]]))
                owner.append(q)
                other.append(sent["other"].to_numpy()[row])
                flag.append(np.zeros(len(q), bool))
            owner, other, sim, flag = (np.concatenate(c) for c in (owner, other, sim, flag))
            # Of a node seen before, the row that knows whether it was expanded.
            order = np.lexsort((~flag, other, owner))
            o, t = owner[order], other[order]
            order = order[np.concatenate([[True], (o[1:] != o[:-1]) | (t[1:] != t[:-1])])]
            owner, other, sim, flag = (c[order] for c in (owner, other, sim, flag))
            best = _best(owner, other, sim, BEAM)
            owner, other, sim, flag = (c[best] for c in (owner, other, sim, flag))
            ends = np.searchsorted(owner, np.arange(len(mine) + 1))
            cut = [slice(a, b) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            return mine[["bucket", "q", "y"]].assign(
                seen=[other[c] for c in cut], sims=[sim[c].astype("f4") for c in cut], done=[flag[c] for c in cut]
            )

        state = state.groupBy("bucket").cogroup(sent.groupBy("bucket")).applyInPandas(
            step, "bucket long, q long, y binary, seen array<long>, sims array<float>, done array<boolean>"
        )
    return state.select("q", F.explode(F.slice("seen", 1, 2 * TOP)).alias("node"))


def nearest_neighbours(
    vectors: DataFrame,
    every: int = 20,
    top: int = TOP,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for ids divisible by ``every`` their ``top`` nearest found.

    Scores are inner products of the vectors as given, in double precision; ties go to smaller ids.  Null, zero and
    non-finite vectors and null ids take no part; an empty table gives no rows.  Vectors of different lengths have no
    inner product: each length has a graph of its own, and a query's candidates are vectors of its length.  Of equal
    vectors, any number, the smallest ``top + 1`` ids are remembered, which is all a result can hold.  Rows that share
    an id and a vector count once; rows that share just an id are rows of their own, never each other's neighbours, and
    as queries each has its own neighbours.  Other columns are not looked at.
    """
    good = stored(valid_vectors(vectors, id_col, vec_col).dropDuplicates(), "vectors")
    lengths = [r["n"] for r in good.select(F.size("v").alias("n")).distinct().orderBy("n").collect()]
    found = [_of_one_length(good.where(F.size("v") == n), n + 1, every, top) for n in lengths]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, found)


def _of_one_length(good: DataFrame, width: int, every: int, top: int) -> DataFrame:
    """The result over vectors of ``width - 1`` components."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    kept = good.withColumn("_r", rank).where(F.col("_r") <= top + 1)
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    longest = good.agg(F.max(square)).first()[0] or 0.0
    groups = stored(
        kept.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .withColumn("more", F.sqrt(F.greatest(F.lit(0.0), F.lit(longest) - square)))
        .withColumn("node", F.monotonically_increasing_id()),
        "groups",
    )
    scale = float(np.sqrt(longest)) or 1.0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(1).flatten().to_numpy().reshape(-1, width - 1)
            x = (np.column_stack([v, batch.column(2).to_numpy()]) / scale).astype("<f4")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], batch.schema.names[:1] + ["x"]
            )

    nodes = stored(groups.select("node", "v", "more").mapInArrow(pack, "node long, x binary"), "nodes")
    deal = max(partitions(good.sparkSession), ceil(nodes.count() / BUCKET_NODES))
    graph = build_graph(nodes, width, deal)
    asked = good.where(F.col("vec_id") % every == 0)
    own = groups.select("v", F.col("node").alias("start"))
    # A query is a row, so it has a number beside its id.
    started = asked.join(own, "v").select("vec_id", "start", "v", F.monotonically_increasing_id().alias("q"))
    started = stored(started, "queries")
    packed = started.withColumn("more", F.lit(0.0)).select("q", "v", "more").mapInArrow(pack, "q long, x binary")
    queries = packed.withColumnRenamed("x", "y").join(started.select("q", "start"), "q")
    found = search(queries, nodes, graph, width, deal)
    product = F.aggregate(F.zip_with("qv", "v", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    scored = (
        found.join(groups.select("node", "v", "ids"), "node")
        .join(started.select("q", F.col("vec_id").alias("query_id"), F.col("v").alias("qv")), "q")
        .select("q", "query_id", product.alias("score"), F.explode("ids").alias("vec_id"))
        .where("query_id != vec_id")
    )
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )
