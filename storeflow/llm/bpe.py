"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Texts are split into pre-tokens in blocks of documents.  A block keeps, for each document, the places of its
pre-tokens in the block's list of distinct words, and sends that list on, dealt by word.  Where all blocks'
words of one kind meet, each distinct word is encoded once.  The ids go back to the blocks, where documents
are put together by position.  Decoding looks ids up in the table of token bytes.

A word as common as one likes travels once per block, whatever it counts there.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeflow.llm.common import id_and_text, pack_ids, partitions, unpack_ids

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
# Characters of a block; a longer document is a block of its own.
BLOCK_CHARS = 3_000_000
# Stretches whose pre-tokens a task remembers.
MOST_PIECES = 150_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _squeeze(*arrays: np.ndarray) -> bytes:
    raw = b"".join(struct.pack("<I", a.nbytes) + a.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _stretch(blob: bytes) -> list[bytes]:
    raw, out, at = zstandard.ZstdDecompressor().decompress(blob), [], 0
    while at < len(raw):
        (n,) = struct.unpack_from("<I", raw, at)
        out.append(raw[at + 4 : at + 4 + n])
        at += 4 + n
    return out


def _planes(values: np.ndarray) -> np.ndarray:
    """Bytes of equal weight side by side: they squeeze better."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def pre_tokens(pattern: str) -> Callable[[str, dict[str, int]], np.ndarray]:
    """Text to places of its pre-tokens in a list of words that grows on the way.

    Before a single space that follows and precedes other characters than white space a pre-token always
    begins, so the stretches between are split once and remembered.
    """
    find = regex.compile(pattern).findall
    known: dict[str, list[int] | None] = {}
    owner: list[dict[str, int]] = [{}]
    pieces: dict[str, list[str]] = {}

    def split(text: str, words: dict[str, int]) -> np.ndarray:
        if owner[0] is not words:
            known.clear()
            owner[0] = words

        def places(part: str) -> list[int]:
            found = pieces.get(part)
            if found is None:
                found = find(part)
                if len(part) < 40:
                    if len(pieces) > MOST_PIECES:
                        pieces.clear()
                    pieces[part] = found
            return [words.setdefault(w, len(words)) for w in found]

        head, *rest = text.split(" ")
        out = places(head)
        for part in rest:
            found = known.get(part)
            if found is None:
                if not part or part[0].isspace():
                    return np.array(places(text), np.uint32)
                found = known[part] = places(" " + part)
            out += found
        return np.array(out, np.uint32)

    return split


def _blocks(batches: Iterator[pa.RecordBatch], pattern: str) -> Iterator[tuple[int, list[str], list[tuple]]]:
    """(block key, distinct words, [(doc_id, places)]).  The key is taken from what the block holds."""
    split = pre_tokens(pattern)
    words: dict[str, int] = {}
    docs: list[tuple] = []
    size = 0

    def done() -> tuple[int, list[str], list[tuple]]:
        digest = xxhash.xxh3_64()
        for doc, places in docs:
            digest.update(f"{doc} ".encode())
            digest.update(places.tobytes())
        listed = list(words)
        digest.update("\0".join(listed).encode("utf-8", "surrogatepass"))
        return digest.intdigest() - (1 << 63), listed, docs

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if docs and size + len(text) > BLOCK_CHARS:
                yield done()
                words, docs, size = {}, [], 0
            docs.append((doc, split(text, words)))
            size += len(text)
    if docs:
        yield done()


def encode_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks_path: str = RANKS,
    pattern: str = PATTERN,
    result: Callable[[list[int]], tuple] | None = None,
    result_schema: str = "ids binary",
) -> DataFrame:
    """One row per document: (doc_id, n_tokens, ids), ids as little-endian 32-bit numbers.

    With ``result``, the columns of ``result_schema`` instead of ids, as it makes them from a document's ids: where only
    a digest is wanted, ids then need not leave the task.

    Null and empty texts have no ids.  Repeated rows and null ids are encoded like any other row; other columns
    are not looked at.
    """
    source = id_and_text(docs, id_col, text_col)
    deal = partitions(docs.sparkSession)
    columns = ["doc_id", "n_tokens", *(field.split()[0] for field in result_schema.split(","))]

    def blocks_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each block, its words by group, and a row with its documents' places among them."""
        for block, words, held in _blocks(batches, pattern):
            codes = [w.encode("utf-8", "surrogatepass") for w in words]
            to = np.array([xxhash.xxh3_64_intdigest(c) % deal for c in codes], np.int64)
            order = np.argsort(to, kind="stable")
            cuts = np.flatnonzero(np.diff(to[order], prepend=-1))
            parts = [part for part in np.split(order, cuts[1:]) if len(part)]
            # A word is named by its place among its group's words and the group, so neither need be sent with it.
            named = np.empty(len(words), np.int64)
            for part in parts:
                named[part] = np.arange(len(part)) * deal + to[part]
            blobs = [
                _squeeze(
                    _planes(np.array([len(codes[i]) for i in part], "<u4")),
                    np.frombuffer(b"".join([codes[i] for i in part]), np.uint8),
                )
                for part in parts
            ]
            lengths = np.array([len(p) for _, p in held], "<u4")
            places = _squeeze(lengths, _planes(named[np.concatenate([p for _, p in held])]))
            n = len(blobs)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*to[order][cuts].tolist(), block], pa.int64()),
                    pa.array([block] * (n + 1), pa.int64()),
                    pa.array([-1] * n + [int(named.max(initial=-1)) + 1], pa.int64()),
                    pa.array([None] * n + [pack_ids([doc for doc, _ in held])], pa.binary()),
                    pa.array([*blobs, places], pa.binary()),
                ],
                ["to", "block", "n_words", "docs", "payload"],
            )

    def encode_words(group: pd.DataFrame) -> pd.DataFrame:
        # Places stay for the blocks' own groups.
        group = group[group["n_words"] < 0]
        if not len(group):
            return pd.DataFrame({"block": np.empty(0, np.int64), "ids": []})
        encoding = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=read_ranks(ranks_path), special_tokens={})
        known: dict[bytes, np.ndarray] = {}
        to, out = group["to"].to_numpy()[:1].astype("<u4"), []
        for blob in group["payload"]:
            lengths, text = _stretch(blob)
            ids, at = [], 0
            for n in _from_planes(lengths).tolist():
                word = text[at : at + n]
                at += n
                found = known.get(word)
                if found is None:
                    found = known[word] = np.array(
                        encoding.encode_ordinary(word.decode("utf-8", "surrogatepass")), "<u4"
                    )
                ids.append(found)
            counts = np.array([len(x) for x in ids], "<u4")
            flat = np.concatenate(ids) if ids else np.empty(0, "<u4")
            out.append(_squeeze(to, _planes(counts), _planes(flat)))
        return pd.DataFrame({"block": group["block"].to_numpy(), "ids": out})

    def together(places: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        places = places[places["n_words"] >= 0]
        if len(places):
            n = int(places["n_words"].iloc[0])
            # Numbers between those of words stand for nothing and have no ids.
            counts, parts = np.zeros(n, np.int64), []
            for blob in words["ids"]:
                to, lengths, flat = _stretch(blob)
                lengths = _from_planes(lengths)
                at = np.arange(len(lengths)) * deal + int(np.frombuffer(to, "<u4")[0])
                counts[at] = lengths
                parts.append((at, _from_planes(flat)))
            begins = np.concatenate([[0], np.cumsum(counts)])
            table = np.empty(int(begins[-1]), "<u4")
            for at, flat in parts:
                table[_ranges(begins[at], counts[at])] = flat
            for docs, blob in zip(places["docs"], places["payload"], strict=True):
                lengths, flat = _stretch(blob)
                all_places, end = _from_planes(flat), 0
                if not counts[all_places].all():
                    raise RuntimeError("a block's words are not all there")
                for doc, length in zip(unpack_ids(docs), np.frombuffer(lengths, "<u4").tolist(), strict=True):
                    mine = all_places[end : end + length].astype(np.int64)
                    end += length
                    ids = table[_ranges(begins[mine], counts[mine])]
                    rows.append((doc, len(ids), *(result(ids.tolist()) if result else (ids.tobytes(),))))
        out = pd.DataFrame([row[1:] for row in rows], columns=columns[1:]).astype({"n_tokens": "int64"})
        out.insert(0, "doc_id", pd.array([row[0] for row in rows], "Int64"))
        return out

    # Words go to their group and places to their block in one exchange, which both readers below share: the text is
    # split once.  Blocks are named by hashes far above the numbers of groups.
    dealt = source.mapInArrow(blocks_out, "to long, block long, n_words long, docs binary, payload binary")
    encoded = dealt.groupBy("to").applyInPandas(encode_words, "block long, ids binary")
    return dealt.groupBy("to").cogroup(encoded.groupBy("block")).applyInPandas(
        together, f"doc_id long, n_tokens long, {result_schema}"
    )


def _ranges(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """begin, begin+1, ... for each count, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts - begins, counts)


def token_bytes(ranks_path: str = RANKS) -> list[bytes]:
    """The token-byte table: as many entries as the vocabulary, held by every task that decodes."""
    ranks = read_ranks(ranks_path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def decode_ids(ids: list[int], table: list[bytes]) -> bytes:
    return b"".join([table[i] for i in ids])


def digests(ranks_path: str = RANKS) -> Callable[[list[int]], tuple[str, str]]:
    """SHA-256 of the decimal ids joined by commas, and of the decoded bytes."""
    table = token_bytes(ranks_path)
    digits = [b"%d" % i for i in range(len(table))]

    def both(ids: list[int]) -> tuple[str, str]:
        listed = b",".join([digits[i] for i in ids])
        return hashlib.sha256(listed).hexdigest(), hashlib.sha256(decode_ids(ids, table)).hexdigest()

    return both


def decode_documents(encoded: DataFrame, ids_col: str = "ids", ranks_path: str = RANKS) -> DataFrame:
    """The same rows with ``decoded`` (bytes).  Null ids give null; an unknown id raises."""
    place = encoded.columns.index(ids_col)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(ranks_path)
        for batch in batches:
            out = [
                None if ids is None else decode_ids(np.frombuffer(ids, "<u4").tolist(), table)
                for ids in batch.column(place).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "decoded"]
            )

    return encoded.mapInArrow(decode, encoded.withColumn("decoded", F.lit(None).cast("binary")).schema)


def id_text(encoded: DataFrame, ids_col: str = "ids") -> DataFrame:
    """The same rows with ``ids_text``: decimal ids joined by commas, as bytes."""
    place = encoded.columns.index(ids_col)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = [b"%d" % i for i in range(1 << 16)]
        for batch in batches:
            out = []
            for ids in batch.column(place).to_pylist():
                values = np.frombuffer(ids, "<u4").tolist()
                digits.extend(b"%d" % i for i in range(len(digits), max(values, default=0) + 1))
                out.append(b",".join([digits[i] for i in values]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "ids_text"]
            )

    return encoded.mapInArrow(write, encoded.withColumn("ids_text", F.lit(None).cast("binary")).schema)
