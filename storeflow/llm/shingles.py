"""Hashed words and word n-grams, and an exchange that counts in how many documents an n-gram stands.

N-grams are compared by hashes of 56 bits within one of ``deal`` counting groups (61 bits with 32 groups).  They travel
in packed arrays: a block of documents sends each group one row with that group's n-grams, document by document.  The
number of groups follows ``spark.sql.shuffle.partitions``, and the input where that is larger; n-grams are dealt by
hash and stand once per document, so groups are even.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from storeflow.llm.common import groups_for, words

BLOCK_NGRAMS = 2_000_000
# Bytes of texts or sets per counting group.
GROUP_BYTES = 64 << 20
# Bytes of an n-gram's hash on its way, and of the number of documents it stands in (no more than these tell).
SENT, MOST_DOCS = 7, (1 << 16) - 1
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def word_hasher(most: int = 400_000) -> Callable[[list[bytes]], np.ndarray]:
    """Words to 64-bit hashes; remembers up to ``most`` words."""
    known: dict[bytes, int] = {}

    def hashes(found: list[bytes]) -> np.ndarray:
        if len(known) > most:
            known.clear()
        for word in {w for w in found if w not in known}:
            known[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(known.__getitem__, found), np.uint64, len(found))

    return hashes


def mixed(values: np.ndarray) -> np.ndarray:
    """A well spread permutation of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = values ^ (values >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def ngram_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; of the whole sequence, if it is shorter but not empty."""
    if not len(hashes):
        return hashes
    span = min(width, len(hashes))
    n = len(hashes) - span + 1
    out = np.full(n, span, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(span):
            out = mixed(out * np.uint64(MIX[0]) + hashes[k : k + n])
    return out


def shingle_sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, sorted distinct n-grams) of each document."""
    hasher = word_hasher()
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            yield doc, np.unique(ngram_hashes(hasher(words(text)), width))


def _narrow(keys: np.ndarray) -> bytes:
    """The low ``SENT`` bytes of 64-bit numbers."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SENT].tobytes()


def _wide(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // SENT, 8), np.uint8)
    out[:, :SENT] = np.frombuffer(raw, np.uint8).reshape(-1, SENT)
    return out.view("<u8").ravel()


BLOCKED = "deal long, block long, head boolean, payload binary"


def blocks(sets: Iterable[tuple], deal: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``BLOCKED`` for (doc_id, set size, n-grams) of documents, a block at a time."""
    held: list[tuple] = []
    size = 0

    def done() -> pa.RecordBatch:
        keys = np.concatenate([k for _, _, k in held])
        docs = np.array([-1 if d is None else d for d, _, _ in held], np.int64)
        heads = np.array([d is not None for d, _, _ in held], bool)
        sizes = np.array([n for _, n, _ in held], np.int64)
        owner = np.repeat(np.arange(len(held)), [len(k) for _, _, k in held])
        to = (keys % np.uint64(deal)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        cuts = np.searchsorted(to[order], np.arange(deal + 1))
        block = xxhash.xxh3_64(keys.tobytes() + docs.tobytes()).intdigest() - (1 << 63)
        deals, payloads = [block % deal], [docs.tobytes() + sizes.tobytes() + heads.tobytes()]
        for d in range(deal):
            mine = order[cuts[d] : cuts[d + 1]]
            if len(mine):
                deals.append(d)
                counts = np.bincount(owner[mine], minlength=len(held)).astype("<u4")
                head = np.array([d, len(held)], "<u4").tobytes()
                payloads.append(head + counts.tobytes() + _narrow(keys[mine] // np.uint64(deal)))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(deals, pa.int64()),
                pa.array([block] * len(deals), pa.int64()),
                pa.array([True] + [False] * (len(deals) - 1)),
                pa.array(payloads, pa.binary()),
            ],
            ["deal", "block", "head", "payload"],
        )

    for doc, n, keys in sets:
        if held and size + len(keys) > BLOCK_NGRAMS:
            yield done()
            held, size = [], 0
        held.append((doc, n, keys))
        size += len(keys)
    if held:
        yield done()


def _unpack(payload: bytes) -> tuple[int, np.ndarray, bytes]:
    """(group, n-grams per document, the rest)."""
    d, n = np.frombuffer(payload, "<u4", 2).tolist()
    return d, np.frombuffer(payload, "<u4", n, 8), payload[8 + 4 * n :]


def _count(group: pd.DataFrame) -> pd.DataFrame:
    """Of each row only the n-grams that stand in more than one document, with their number of documents."""
    out = list(group["payload"])
    body = [k for k, head in enumerate(group["head"]) if not head]
    if body:
        parts = [(*_unpack(out[k])[:2], _wide(_unpack(out[k])[2])) for k in body]
        keys = np.concatenate([p[2] for p in parts])
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        df = np.minimum(counts, MOST_DOCS)[inverse].astype("<u2")
        at = 0
        for k, (d, per_doc, mine) in zip(body, parts, strict=True):
            mine_df = df[at : at + len(mine)]
            at += len(mine)
            shared = mine_df > 1
            owner = np.repeat(np.arange(len(per_doc)), per_doc)[shared]
            per_doc = np.bincount(owner, minlength=len(per_doc)).astype("<u4")
            head = np.array([d, len(per_doc)], "<u4").tobytes()
            out[k] = head + per_doc.tobytes() + _narrow(mine[shared]) + mine_df[shared].tobytes()
    return pd.DataFrame({"block": group["block"].to_numpy(), "head": group["head"].to_numpy(), "payload": out})


def prefix_length(n: int, shared: int, percent: int) -> int:
    """How many shared n-grams a document's prefix holds behind those of this document alone."""
    return n - -(-n * percent // 100) + 1 - (n - shared)


def _gather(group: pd.DataFrame, deal: int, percent: int) -> pd.DataFrame:
    """Documents of a block with their shared n-grams, rarest first; without them if none is in the prefix."""
    names = ["doc_id", "n", "shared", "keys"]
    heads = group.loc[group["head"], "payload"].tolist()
    if not heads:
        return pd.DataFrame({n: [] for n in names})
    heads = heads[:1] if len(set(heads)) == 1 and len(heads) > 1 else heads
    m = len(heads[0]) // 17
    docs = np.frombuffer(heads[0], np.int64, m)
    sizes = np.frombuffer(heads[0], np.int64, m, 8 * m)
    known = np.frombuffer(heads[0], bool, m, 16 * m)
    owners, keys, dfs = [], [], []
    # Equal blocks (repeated rows) come more than once, with equal rows.
    for payload in set(group.loc[~group["head"], "payload"]):
        d, per_doc, rest = _unpack(payload)
        count = int(per_doc.sum())
        keys.append(_wide(rest[: SENT * count]) * np.uint64(deal) + np.uint64(d))
        dfs.append(np.frombuffer(rest, "<u2", count, SENT * count))
        owners.append(np.repeat(np.arange(len(per_doc)), per_doc))
    owner = np.concatenate(owners) if owners else np.empty(0, np.int64)
    key = np.concatenate(keys) if keys else np.empty(0, "<u8")
    df = np.concatenate(dfs) if dfs else np.empty(0, "<u2")
    order = np.lexsort((key, df, owner))
    key = key[order]
    ends = np.searchsorted(owner[order], np.arange(m + 1))
    repeats = int(group["head"].sum())
    out = pd.DataFrame(
        {
            "doc_id": pd.array([int(d) if k else None for d, k in zip(docs, known, strict=True)], "Int64"),
            "n": sizes,
            "shared": np.diff(ends),
            "keys": [
                key[i:j].tobytes() if prefix_length(n, j - i, percent) > 0 else b""
                for n, i, j in zip(sizes.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True)
            ],
        }
    )
    return pd.concat([out] * repeats) if repeats > 1 else out


def shared_ngrams(blocked: DataFrame, deal: int, percent: int) -> DataFrame:
    """One row per document: (doc_id, n, shared, keys): set size, how many of its n-grams other documents hold too, and
    these, rarest first (then by hash), as 64-bit numbers; no keys where the prefix for ``percent`` holds none of them."""

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        return _gather(group, deal, percent)

    return (
        blocked.groupBy("deal")
        .applyInPandas(_count, "block long, head boolean, payload binary")
        .groupBy("block")
        .applyInPandas(gather, "doc_id long, n long, shared long, keys binary")
    )


def shared_of_texts(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """:func:`shared_ngrams` of (doc_id, text)."""
    deal = groups_for(docs, GROUP_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return blocks(((d, len(k), k) for d, k in shingle_sets(batches, width)), deal)

    return shared_ngrams(docs.mapInArrow(run, BLOCKED), deal, percent)


def shared_of_sets(sets: DataFrame, percent: int, deal: int) -> DataFrame:
    """:func:`shared_ngrams` of (doc_id, n, keys), in ``deal`` counting groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for batch in batches:
                for doc, n, keys in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                    yield doc, n, np.frombuffer(keys, "<u8")

        return blocks(each(), deal)

    return shared_ngrams(sets.select("doc_id", "n", "keys").mapInArrow(run, BLOCKED), deal, percent)
