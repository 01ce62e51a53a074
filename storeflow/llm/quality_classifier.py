"""Quality classifier: importance resampling with hashed n-gram models of target and raw text.

Both models are bags of hashed unigrams and bigrams of words and runs of punctuation.  A document's weight is
the log ratio of its probability under the target and under the raw model; Gumbel noise is added and the
documents with the k largest sums are kept, which samples without replacement by weight.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeflow.llm.common import id_and_text, stored
from storeflow.plans.skew import BROADCAST_ROWS

BUCKETS = 1 << 16
# The target model is drawn towards the raw one as by so many n-grams per bucket, each as likely as there: what a small
# target sample cannot have shown is not held against a text.
SMOOTHING = 2.0
# Of the Gumbel noise: log weights are sums over hundreds of n-grams, far larger.
NOISE = 1.0
# Weights of very short texts are about zero and say little: they are not held against a text.
TOLERANCE = 4.0
SEED = 17
TOKENS = r"\w+|[^\w\s]+"
BINS = 1024


def good_ids(labels: DataFrame) -> DataFrame:
    """Distinct ``doc_id`` of good, harmless labelled documents; null labels do not count."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0))
    return good.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()


def target_ids(labels: DataFrame) -> np.ndarray:
    """The same ids, sorted, on the driver; for looking at a table of few labels."""
    return np.sort(np.array([r[0] for r in good_ids(labels).collect()], np.int64))


def hashed_ngrams(texts: Iterator[str], buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Bucket of every unigram and bigram of each text."""
    find = re.compile(TOKENS).findall
    known: dict[str, int] = {}
    for text in texts:
        if len(known) > 500_000:
            known.clear()
        found = find(text)
        for token in {t for t in found if t not in known}:
            known[token] = xxhash.xxh3_64_intdigest(token.encode("utf-8", "surrogatepass"))
        hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        with np.errstate(over="ignore"):
            pairs = (hashes[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (hashes[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
            pairs ^= pairs >> np.uint64(32)
        yield np.concatenate([hashes, pairs]) % np.uint64(buckets)


def _chunks(arrays: Iterator[np.ndarray], least: int = 1 << 20) -> Iterator[np.ndarray]:
    """The same numbers in arrays of at least ``least``, but for the last."""
    held: list[np.ndarray] = []
    size = 0
    for a in arrays:
        held.append(a)
        size += len(a)
        if size >= least:
            yield np.concatenate(held)
            held, size = [], 0
    if held:
        yield np.concatenate(held)


def fit(docs: DataFrame, targets: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Log ratio of target and raw probability of each bucket; the raw model is that of all documents, the target
    model that of all whose id is in ``targets`` (distinct ``doc_id``).

    Tasks count into one vector of ``buckets`` numbers per model; those are added up by bucket.  Ids go to every
    executor if they are few, and are joined as Spark sees fit if not: the model is the same.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, buckets), np.int64)
        for batch in batches:
            texts, mine = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for model in (0, 1):
                some = [t for t, m in zip(texts, mine, strict=True) if (m is None) == (model == 1)]
                for part in _chunks(hashed_ngrams(some, buckets)):
                    sums[model] += np.bincount(part.astype(np.int64), minlength=buckets)
        sums[1] += sums[0]
        seen = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(sums[0][seen]), pa.array(sums[1][seen])], ["bucket", "target", "raw"]
        )

    marked = targets.select("doc_id", F.lit(True).alias("target"))
    if targets.count() <= BROADCAST_ROWS:
        marked = F.broadcast(marked)
    found = (
        docs.join(marked, "doc_id", "left")
        .select("text", "target")
        .mapInArrow(count, "bucket long, target long, raw long")
        .groupBy("bucket")
        .agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))
        .collect()  # at most ``buckets`` rows
    )
    counts = np.zeros((2, buckets))
    for bucket, target, raw in found:
        counts[:, bucket] = target, raw
    expected = counts[1] * (counts[0].sum() / max(counts[1].sum(), 1.0))
    return np.log(counts[0] + SMOOTHING) - np.log(expected + SMOOTHING)


def weigh(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """(doc_id, n_ngrams, log_weight, text_hash) of (doc_id, text, text_hash)."""
    buckets = len(ratios)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, weight = [], []
            for ngrams in hashed_ngrams(batch.column(1).to_pylist(), buckets):
                n.append(len(ngrams))
                weight.append(float(ratios[ngrams].sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(weight, pa.float64()), batch.column(2)],
                ["doc_id", "n_ngrams", "log_weight", "text_hash"],
            )

    return docs.mapInArrow(score, "doc_id long, n_ngrams long, log_weight double, text_hash long")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise fixed by the document's id."""
    uniform = (F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(seed)), 12) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(-F.log(uniform))


def kth_largest(df: DataFrame, column: str, k: int) -> float:
    """The k-th largest value, by counting in ``BINS`` bins and looking closer at one of them, until it holds
    one value.  Only counts come to the driver."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    while low < high:
        width = (high - low) / BINS
        if width == 0 or low + width == low:
            width = high - low
        inside = df.where(F.col(column).between(low, high))
        place = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(BINS - 1))
        counts = (
            inside.groupBy(place.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
            .orderBy(F.desc("bin"))
            .collect()
        )
        for r in counts:
            if k <= r["n"]:
                break
            k -= r["n"]
        if len(counts) == 1 and (low, high) == (r["low"], r["high"]):
            return low
        low, high = r["low"], r["high"]
    return low


def resample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: int | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per document: (doc_id, n_ngrams, log_weight, text_hash, gumbel_key, kept).

    ``keep`` documents are sampled; by default as many as have a log weight of at least ``-TOLERANCE``.  Rows with equal keys (repeated ids and texts) stand or fall together; rows that share just an id are judged each, and
    ``text_hash`` (xxhash64 of the text, null as empty) tells them apart.  A null or empty text has
    weight 0, a very long one is weighed whole.  With no target document at all, nothing tells texts apart and
    everything is kept.  An empty table gives no rows; extra columns are not looked at.
    """
    source = id_and_text(docs, id_col, text_col)
    hashed = source.withColumn("text_hash", F.xxhash64("text"))
    targets = stored(good_ids(labels), "targets")
    ratios = np.zeros(buckets) if targets.isEmpty() else fit(source, targets, buckets)
    keys = stored(
        weigh(hashed, ratios).withColumn("gumbel_key", F.col("log_weight") + NOISE * gumbel(F.col("doc_id"))),
        "weights",
    )
    if keep is None:
        keep = keys.where(F.col("log_weight") >= -TOLERANCE).count()
    if keep <= 0:
        return keys.withColumn("kept", F.lit(False))
    if keep >= keys.count():
        return keys.withColumn("kept", F.lit(True))
    return keys.withColumn("kept", F.col("gumbel_key") >= F.lit(kth_largest(keys, "gumbel_key", keep)))
