"""LM scoring: deleted interpolation of maximum-likelihood estimates.

``p(w | v) = a2 c(v w) / c(v) + a1 c(w) / N + a0 / (V + 1)``, where the mixture weights a depend on how often the context v
was seen (one bucket for each power of two).  They are learned by expectation-maximisation on the counts of a
deleted part of the training documents, against estimates from the rest; the model then uses all counts.

Words are 64-bit hashes.  Blocks of documents send their distinct words and word pairs, with counts, to ``deal``
groups by hash; totals come back, and every document gets the counts along its tokens.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeflow.llm.common import id_and_text, pack_ids, partitions, stored, unpack_ids, words
from storeflow.llm.shingles import MIX, mixed, word_hasher

BLOCK_TOKENS = 1_000_000
FOLDS = 7
HELD_OUT = 2  # this remainder is not learned from
DELETED = 6  # and this one is what the weights are learned on
END = xxhash.xxh3_64_intdigest(b"\n")  # no word holds white space
STEPS = 8  # cells per power of two in which ratios are gathered for the weights
ROUNDS = 60
BUCKETS = 40


def fold(doc_id: int | None) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS


def _squeeze(values: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _stretch(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _pairs(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it; before a text stands its end."""
    # END as an unsigned number: beside a signed one the hashes would become floats and lose bits.
    before = np.concatenate([np.array([END], np.uint64), hashes[:-1]])
    before[np.cumsum(lengths)[:-1]] = END
    with np.errstate(over="ignore"):
        return mixed(before * np.uint64(MIX[0]) + mixed(hashes) * np.uint64(MIX[1]))


def _dealt(keys: np.ndarray, deal: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of keys by group, and where each group begins."""
    to = (keys % np.uint64(deal)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    return order, np.searchsorted(to[order], np.arange(deal + 1))


def _short(keys: np.ndarray, deal: int) -> bytes:
    """48 bits of each key beside those that chose its group."""
    return (keys // np.uint64(deal)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _long(blob: bytes) -> np.ndarray:
    wide = np.zeros((len(blob) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, np.ndarray, np.ndarray]]:
    """(block, ids, tokens per document, token hashes)."""
    hasher, docs, parts, size = word_hasher(), [], [], 0

    def done() -> tuple[int, list, np.ndarray, np.ndarray]:
        flat = np.concatenate(parts)
        key = xxhash.xxh3_64(flat.tobytes() + repr(docs).encode()).intdigest() - (1 << 63)
        return key, docs, np.array([len(p) for p in parts], np.int64), flat

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            tokens = np.append(hasher(words(text)), np.uint64(END))
            if docs and size + len(tokens) > BLOCK_TOKENS:
                yield done()
                docs, parts, size = [], [], 0
            docs.append(doc)
            parts.append(tokens)
            size += len(tokens)
    if docs:
        yield done()


def _counts_out(deal: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, docs, lengths, flat in _blocks(batches):
            folds = np.array([fold(d) for d in docs])
            learned = np.repeat(folds != HELD_OUT, lengths)
            kept = np.repeat((folds != HELD_OUT) & (folds != DELETED), lengths)
            columns: list[list] = [[] for _ in range(deal)]
            for keys in (flat, _pairs(flat, lengths)):
                distinct, inverse = np.unique(keys, return_inverse=True)
                order, cuts = _dealt(distinct, deal)
                totals = [
                    np.bincount(inverse, weights=w, minlength=len(distinct)).astype(np.int64)[order]
                    for w in (learned, kept)
                ]
                ordered = distinct[order]
                for d in range(deal):
                    part = slice(cuts[d], cuts[d + 1])
                    columns[d] += [_short(ordered[part], deal), *(_squeeze(t[part]) for t in totals)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(deal), pa.int64()),
                    pa.array([block] * deal, pa.int64()),
                    *(pa.array([c[k] for c in columns], pa.binary()) for k in range(6)),
                ],
                ["deal", "block", "words", "w_all", "w_kept", "pairs", "p_all", "p_kept"],
            )

    return run


def _totals(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """Totals of each row's keys over all rows; every row also carries its group's sums over distinct words."""
    out = {"block": group["block"].to_numpy(), "deal": [key[0]] * len(group)}
    for short, all_, kept in (("words", "w_all", "w_kept"), ("pairs", "p_all", "p_kept")):
        parts = [_long(b) for b in group[short]]
        distinct, inverse = np.unique(np.concatenate(parts), return_inverse=True)
        ends = np.cumsum([len(p) for p in parts])[:-1]
        for name in (all_, kept):
            weights = np.concatenate([_stretch(b) for b in group[name]])
            totals = np.bincount(inverse, weights=weights, minlength=len(distinct)).astype(np.int64)
            out[name] = [_squeeze(p) for p in np.split(totals[inverse], ends)]
            if short == "words":
                out[f"{name}_n"] = [int(totals.sum())] * len(group)
                out[f"{name}_v"] = [int((totals > 0).sum())] * len(group)
    return pd.DataFrame(out)


TOTALS = (
    "block long, deal long, w_all binary, w_all_n long, w_all_v long, w_kept binary, w_kept_n long, w_kept_v long,"
    " p_all binary, p_kept binary"
)


def _places_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, docs, lengths, flat in _blocks(batches):
        distinct, inverse = np.unique(flat, return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([block], pa.int64()),
                pa.array([pack_ids(docs)], pa.binary()),
                pa.array([_squeeze(lengths)], pa.binary()),
                pa.array([distinct.astype("<u8").tobytes()], pa.binary()),
                pa.array([_squeeze(inverse)], pa.binary()),
            ],
            ["block", "docs", "lengths", "words", "places"],
        )


def _together(deal: int):
    def run(places: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        if len(places):
            if totals["deal"].nunique() != deal:
                raise RuntimeError("the input was split differently when it was read again")
            totals = totals.drop_duplicates("deal").sort_values("deal")
            first = places.iloc[0]
            lengths, distinct = _stretch(first["lengths"]), np.frombuffer(first["words"], "<u8")
            place = _stretch(first["places"])
            pairs, pair_place = np.unique(_pairs(distinct[place], lengths), return_inverse=True)

            def along(keys: np.ndarray, at: np.ndarray, column: str) -> np.ndarray:
                values = np.empty(len(keys), np.int64)
                values[_dealt(keys, deal)[0]] = np.concatenate([_stretch(b) for b in totals[column]])
                return values[at]

            one, two = along(distinct, place, "w_all"), along(pairs, pair_place, "p_all")
            one_kept, two_kept = along(distinct, place, "w_kept"), along(pairs, pair_place, "p_kept")
            ends = np.concatenate([[0], np.cumsum(lengths)])
            for k, doc in enumerate(unpack_ids(first["docs"])):
                a, b = ends[k], ends[k + 1]
                deleted = fold(doc) == DELETED
                rows.append(
                    (
                        doc,
                        int(b - a),
                        int(np.count_nonzero(one[a:b])),
                        float(np.log10(one[a:b] + 1.0).sum()),
                        _squeeze(one[a:b]),
                        _squeeze(two[a:b]),
                        _squeeze(one_kept[a:b]) if deleted else None,
                        _squeeze(two_kept[a:b]) if deleted else None,
                    )
                )
            # A block repeated word for word comes as several rows of places and one set of totals.
            rows *= len(places)
        names = ["doc_id", "n_tokens", "n_known", "log_counts", "one", "two", "one_kept", "two_kept"]
        out = pd.DataFrame([row[1:] for row in rows], columns=names[1:])
        out = out.astype({"n_tokens": "int64", "n_known": "int64", "log_counts": "float64"})
        out.insert(0, "doc_id", pd.array([row[0] for row in rows], "Int64"))
        return out

    return run


COUNTED = (
    "doc_id long, n_tokens long, n_known long, log_counts double, one binary, two binary, one_kept binary, two_kept binary"
)


def _estimates(one: np.ndarray, two: np.ndarray, ends: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, pair estimate, word estimate) along a document; ``ends``: how often a text ended."""
    context = np.concatenate([[ends], one[:-1]])
    bucket = np.where(context > 0, np.log2(np.maximum(context, 1)).astype(np.int64) + 1, 0)
    return np.minimum(bucket, BUCKETS - 1), two / np.maximum(context, 1), one / max(n, 1)


def learn_weights(cells: list[tuple[int, int, int, int]], vocabulary: int) -> np.ndarray:
    """Weights [bucket, (pair, word, uniform)] by expectation-maximisation over cells (bucket, pair step, word step, n)."""
    flat = np.array([1 / 3, 1 / 3, 1 / 3])
    weights = np.tile(flat, (BUCKETS, 1))
    if not cells:
        return weights
    bucket, two, one, n = np.array(cells, np.int64).T
    value = np.stack(
        [
            np.where(two > 0, 2.0 ** (-(two - 1.0) / STEPS), 0.0),
            np.where(one > 0, 2.0 ** (-(one - 1.0) / STEPS), 0.0),
            np.full(len(n), 1.0 / (vocabulary + 1)),
        ],
        axis=1,
    )

    def fit(rows: np.ndarray) -> np.ndarray:
        w = flat
        for _ in range(ROUNDS):
            share = value[rows] * w
            share /= share.sum(axis=1, keepdims=True)
            w = (share * n[rows, None]).sum(axis=0) + np.array([0.0, 0.0, 1.0])  # never rules anything out
            w /= w.sum()
        return w

    weights[:] = fit(np.arange(len(n)))
    for b in range(BUCKETS):
        mine = np.flatnonzero(bucket == b)
        if len(mine):
            weights[b] = fit(mine)
    return weights


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Tokens are lower-cased (A-Z) words and one end per text.  Scores are log10 probabilities of whole texts, under add-one
    word counts (``base_score``) and under the interpolated model.  Null and empty texts are the end alone.  Repeated rows
    count and are scored as often as they occur; a null id counts as an empty one for its fold; an empty table gives
    no rows; other columns are not looked at.
    """
    source = id_and_text(docs, id_col, text_col)
    deal = partitions(docs.sparkSession)
    totals = (
        source.mapInArrow(
            _counts_out(deal),
            "deal long, block long, words binary, w_all binary, w_kept binary, pairs binary, p_all binary, p_kept binary",
        )
        .groupBy("deal")
        .applyInPandas(_totals, TOTALS)
    )
    totals = stored(totals, "totals")
    sums = totals.groupBy("deal").agg(*[F.max(f"w_{x}").alias(x) for x in ("all_n", "all_v", "kept_n", "kept_v")])
    n, v, n_kept, v_kept = (x or 0 for x in sums.agg(*[F.sum(c) for c in sums.columns[1:]]).first())
    places = source.mapInArrow(
        _places_out, "block long, docs binary, lengths binary, words binary, places binary"
    )
    counted = stored(
        places.groupBy("block").cogroup(totals.groupBy("block")).applyInPandas(_together(deal), COUNTED), "counted"
    )
    folds = [F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == f
             for f in (HELD_OUT, DELETED)]
    ends = counted.select(
        F.count(F.when(~folds[0], 1)).alias("all"), F.count(F.when(~folds[0] & ~folds[1], 1)).alias("kept")
    ).first()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, int] = {}
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                bucket, two, one = _estimates(_stretch(a), _stretch(b), ends["kept"], n_kept)
                steps = [
                    np.where(x > 0, np.rint(-np.log2(np.maximum(x, 1e-18)) * STEPS).astype(np.int64) + 1, 0)
                    for x in (two, one)
                ]
                codes, counts = np.unique((bucket << 40) | (steps[0] << 20) | steps[1], return_counts=True)
                for code, c in zip(codes.tolist(), counts.tolist(), strict=True):
                    found[code] = found.get(code, 0) + c
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], ["cell", "n"]
        )

    # At most one row per cell of a fixed grid.
    cells = (
        counted.where("one_kept IS NOT NULL")
        .select("one_kept", "two_kept")
        .mapInArrow(gather, "cell long, n long")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    weights = learn_weights([(c >> 40, (c >> 20) & 0xFFFFF, c & 0xFFFFF, k) for c, k in cells], v_kept)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
                bucket, two, one = _estimates(_stretch(a), _stretch(b), ends["all"], n)
                w = weights[bucket]
                out.append(float(np.log10(w[:, 0] * two + w[:, 1] * one + w[:, 2] / (v + 1)).sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(out, pa.float64())], [*batch.schema.names[:4], "score"]
            )

    return (
        counted.select("doc_id", "n_tokens", "n_known", "log_counts", "one", "two")
        .mapInArrow(score, "doc_id long, n_tokens long, n_known long, log_counts double, score double")
        .select(
            "doc_id",
            folds[0].alias("held_out"),
            "n_tokens",
            "n_known",
            F.lit(int(n)).cast("long").alias("train_tokens"),
            (F.col("log_counts") - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))).alias("base_score"),
            "score",
        )
    )
