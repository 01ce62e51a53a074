"""Packing: best-fit decreasing with a segment tree indexed by remaining capacity.

Documents are tokenized and cut into full windows and a remainder.  Pieces are dealt to shards of about
``SHARD_WINDOWS`` windows; within one, pieces go from long to short into the open window with the least room
that still fits.  A shard leaves about one window partly empty, so padding is about 1/SHARD_WINDOWS.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeflow.llm.bpe import read_ranks
from storeflow.llm.common import id_and_text, stored

WINDOW = 2048
END_ID = 1
SHARD_WINDOWS = 1024
SHARD_PIECES = 200_000
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
# Bytes of texts and ids a task remembers before it starts over.
CACHE_BYTES = 128_000_000


def text_encoder(vocabulary: str, ranks_path: str | None) -> Callable[[list[str]], list[bytes]]:
    """Texts to ids (little-endian 32 bits), as the tokenizer gives them for whole texts.

    A single space before anything but white space always begins a new pre-token, and merges never cross
    pre-tokens, so what stands between two such spaces has the same ids anywhere and is encoded once per
    task.  Texts with other runs of white space around a space, and texts that hold an added token, go
    through the tokenizer as a whole.  ``ranks_path`` names a rank file of the same vocabulary; single words are
    then merged by it, which is several times faster and gives the same ids.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
    known: dict[str, bytes | None] = {}
    held = 0

    def whole(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    merge = whole
    if ranks_path:
        merge = tiktoken.Encoding(
            "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(ranks_path), special_tokens={}
        ).encode_ordinary

    def packed(ids: list[int]) -> bytes:
        return array("I", ids).tobytes()

    def encode(texts: list[str]) -> list[bytes]:
        nonlocal held
        if held > CACHE_BYTES:
            known.clear()
            held = 0
        out = []
        for text in texts:
            head, *rest = text.split(" ")
            ids = [packed(merge(head))]
            for part in rest:
                found = known.get(part)
                if found is None:
                    if not part or part[0].isspace():
                        break
                    found = known[part] = packed(merge(" " + part))
                    held += len(part) + len(found) + 150
                ids.append(found)
            plain = len(ids) == len(rest) + 1 and not any(token in text for token in added)
            out.append(b"".join(ids) if plain else packed(whole(text)))
        return out

    return encode


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    ranks_path: str | None = RANKS,
    window: int = WINDOW,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of documents, full windows first: (doc_id, start, length, ids_crc32, doc_tokens[, ids])."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_encoder(vocabulary, ranks_path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                out: list[tuple] = []
                for doc, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist()), strict=True):
                    ids += end
                    n = len(ids) // 4
                    for start in range(0, n, window):
                        piece = ids[4 * start : 4 * (start + window)]
                        out.append((doc, start, len(piece) // 4, zlib.crc32(piece), n, piece))
                columns = list(zip(*out, strict=True))
                kinds = [pa.int64()] * 5 + [pa.binary()]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
                keep = 6 if with_ids else 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns[:keep], kinds, strict=False)], names[:keep]
                )

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return id_and_text(docs, id_col, text_col).mapInArrow(cut, schema)


class RoomTree:
    """A segment tree over remaining capacities: which of them has an open window."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.any = bytearray(2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def push(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        i = self.size + room
        while i and not self.any[i]:
            self.any[i] = 1
            i >>= 1

    def pop(self, room: int) -> int:
        sequence = self.open[room].pop()
        if not self.open[room]:
            i = self.size + room
            self.any[i] = 0
            while i > 1 and not self.any[i ^ 1]:
                i >>= 1
                self.any[i] = 0
        return sequence

    def tightest(self, length: int) -> int | None:
        """The smallest capacity of at least ``length`` that has an open window."""
        i = self.size + length
        while not self.any[i]:
            while i & 1:  # a right child: nothing further right below its parent
                i >>= 1
            if not i:
                return None
            i += 1
        while i < self.size:
            i = 2 * i if self.any[2 * i] else 2 * i + 1
        return i - self.size


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of pieces, which must come from long to short."""
    tree, count = RoomTree(window), 0
    sequences, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for k, length in enumerate(lengths.tolist()):
        room = tree.tightest(length)
        if room is None:
            sequence, room, count = count, window, count + 1
        else:
            sequence = tree.pop(room)
        sequences[k], offsets[k] = sequence, window - room
        if room > length:
            tree.push(room - length, sequence)
    return sequences, offsets


def pack_pieces(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Adds (sequence_id, offset) to pieces of at most ``window`` tokens."""
    numbered = stored(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    tokens, count = numbered.agg(F.sum("length"), F.count(F.lit(1))).first()
    shards = max(1, ceil((tokens or 0) / (window * SHARD_WINDOWS)), ceil(count / SHARD_PIECES))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields]
    names = pieces.columns

    def pack(key, group):
        group = group.sort_values(["length", "_row"], ascending=[False, True])
        sequences, offsets = best_fit(group["length"].to_numpy(), window)
        return group[names].assign(sequence_id=(key[0] << 32) + sequences, offset=offsets)

    return (
        numbered.withColumn("_shard", F.pmod(F.xxhash64("_row"), F.lit(shards)).cast("long"))
        .groupBy("_shard")
        .applyInPandas(pack, ", ".join([*fields, "sequence_id long", "offset long"]))
    )


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens[, ids], sequence_id, offset).

    Null and empty texts are the end id alone.  Repeated rows are packed as often as they occur, null ids like any
    other; an empty table gives no pieces; other columns are not looked at.
    """
    window = options.get("window", WINDOW)
    return pack_pieces(token_pieces(docs, id_col, text_col, **options), window)
