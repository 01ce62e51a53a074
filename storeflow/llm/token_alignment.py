"""Alignment of two tokenizers: which tokens of one cover the same bytes as which tokens of the other.

Tokens by bytes make an incidence matrix per tokenizer, A and B.  The row products of A·Bᵀ are the pairs of tokens
with overlapping byte ranges, their values the bytes shared.  Where a token of each ends on one byte, a group ends; the
product of the two tokens-by-groups matrices gives the pairs that share a group.

Neither tokenizer looks across a space that follows a word, so a text is cut there into units, and a
unit is aligned once per task and remembered.  Documents are lists of units.  A block of documents sends on its distinct id
pairs with their counts; these are added up over the corpus, and come back to the block as what each pair counts.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeflow.llm.bpe import read_ranks
from storeflow.llm.common import id_and_text, pack_ids, stored, unpack_ids

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN
# Characters of a block of documents; a longer document is a block of its own.
BLOCK_CHARS = 4_000_000
# Units a task remembers before it starts over.
MOST_UNITS = 200_000
# Units aligned together.
UNITS_AT_ONCE = 20_000
# Bytes that one product of matrices covers, and products of entries it holds at a time.
CHUNK_BYTES = 1 << 18
MOST_TERMS = 1 << 20

_UNIT = re.compile(" +[^ ]*")
# White space that ends a unit and white space after the next one's space may be one pre-token: no cut there.
_UNSAFE = re.compile(r"[^\S ] \s")


@dataclass(frozen=True)
class Csr:
    """A matrix of ones by rows: row i has the columns ``indices[indptr[i]:indptr[i + 1]]``."""

    indptr: np.ndarray
    indices: np.ndarray
    columns: int

    @staticmethod
    def of_ranges(ends: np.ndarray) -> Csr:
        """Row i covers the columns from the end before to its own."""
        total = int(ends[-1]) if len(ends) else 0
        return Csr(np.concatenate([[0], ends]), np.arange(total), total)

    @staticmethod
    def of_column(column: np.ndarray, columns: int) -> Csr:
        """Row i has just ``column[i]``."""
        return Csr(np.arange(len(column) + 1), column, columns)

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transposed(self) -> Csr:
        """Entries counted per column, then dealt to their places: rows stay in order."""
        indptr = np.concatenate([[0], np.cumsum(np.bincount(self.indices, minlength=self.columns))])
        return Csr(indptr, self.rows()[np.argsort(self.indices, kind="stable")], len(self.indptr) - 1)

    def product(self, other: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gustavson: for each row, the rows of ``other`` that its entries name are added up.

        (row, column, value) of the product's entries, by row, then column.  Rows are taken in stretches of at most
        ``MOST_TERMS`` terms, or one row.
        """
        terms = np.diff(other.indptr)[self.indices]
        upto = np.concatenate([[0], np.cumsum(terms)])[self.indptr]
        found, row, rows = [], 0, len(self.indptr) - 1
        while row < rows:
            stop = max(row + 1, int(np.searchsorted(upto, upto[row] + MOST_TERMS, "right")) - 1)
            entries = slice(self.indptr[row], self.indptr[stop])
            counts = terms[entries]
            ends = np.cumsum(counts)
            total = int(ends[-1]) if len(ends) else 0
            at = np.arange(total) + np.repeat(other.indptr[self.indices[entries]] - ends + counts, counts)
            of = np.repeat(np.arange(row, stop), np.diff(upto[row : stop + 1]))
            found.append(np.unique(of * other.columns + other.indices[at], return_counts=True))
            row = stop
        keys = np.concatenate([k for k, _ in found]) if found else np.empty(0, np.int64)
        values = np.concatenate([v for _, v in found]) if found else np.empty(0, np.int64)
        wide = max(1, other.columns)
        return keys // wide, keys % wide, values


def group_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """Byte offsets at which a token of each ends."""
    return np.intersect1d(a_ends, b_ends, assume_unique=True)


def overlap_links(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of a, token of b, bytes shared) for all pairs that overlap."""
    return _by_stretch(
        a_ends, b_ends, lambda a, b, shared: Csr.of_ranges(a).product(Csr.of_ranges(b).transposed())
    )


def group_links(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of a, token of b, 1) for all pairs that share a group."""

    def product(a: np.ndarray, b: np.ndarray, shared: np.ndarray):
        groups = [Csr.of_column(np.searchsorted(shared, ends), len(shared)) for ends in (a, b)]
        return groups[0].product(groups[1].transposed())

    return _by_stretch(a_ends, b_ends, product)


def _by_stretch(a_ends: np.ndarray, b_ends: np.ndarray, product):
    """A product over stretches of about ``CHUNK_BYTES`` that end where a group does."""
    shared = group_ends(a_ends, b_ends)
    found, a, b, g = [], 0, 0, 0
    while g < len(shared):
        begin = int(shared[g - 1]) if g else 0
        h = max(g + 1, int(np.searchsorted(shared, begin + CHUNK_BYTES, "right")))
        a_to, b_to = (int(np.searchsorted(ends, shared[h - 1], "right")) for ends in (a_ends, b_ends))
        rows, columns, values = product(a_ends[a:a_to] - begin, b_ends[b:b_to] - begin, shared[g:h] - begin)
        found.append((rows + a, columns + b, values))
        a, b, g = a_to, b_to, h
    return tuple(np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(3))


class Unit(NamedTuple):
    """What the alignment of a unit gives; ``pairs`` are its links' a << 32 | b as 64-bit numbers."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    n_group_links: int
    groups: bytes
    pairs: bytes


class Aligner:
    """Both tokenizers and the units seen so far."""

    def __init__(self, ranks_path: str, pieces_path: str):
        ranks = read_ranks(ranks_path)
        self.encode_a = tiktoken.Encoding(
            "a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        self.a_lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.a_lengths[rank] = len(token)
        self.b_bytes = [self._piece(i) for i in range(self.pieces.get_piece_size())]
        self.b_lengths = np.array([len(p) for p in self.b_bytes], np.int64)
        self.lone_space = self.pieces.piece_to_id("▁")
        # Does any piece go on with a space mark?  Then texts cannot be cut at spaces.
        self.cuts = not any(re.search("[^▁]▁", self.pieces.id_to_piece(i)) for i in range(len(self.b_bytes)))
        # Ids in digits with what may follow them.
        self.a_written, self.b_written = (
            {mark: np.array([b"%d%s" % (i, mark) for i in range(n)], object) for mark in (b",", last)}
            for n, last in ((len(self.a_lengths), b"|"), (len(self.b_bytes), b";"))
        )
        self.known: dict[str, Unit | None] = {}
        # Units that the pieces do not give back.
        self.odd: set[str] = set()

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        if self.pieces.is_byte(i):
            return bytes([int(piece[1:-1], 16)])
        return piece.replace("▁", " ").encode()

    def units(self, text: str) -> list[str]:
        """Space and text, cut where neither tokenizer looks across."""
        spaced = " " + text
        return [spaced] if not self.cuts or _UNSAFE.search(spaced) else _UNIT.findall(spaced)

    def encode_b(self, units: list[str]) -> list[list[int]]:
        """Ids; the space before each unit is the one the tokenizer adds."""
        found = self.pieces.encode([u[1:] for u in units], num_threads=1)
        return [ids if unit != " " else [self.lone_space] for unit, ids in zip(units, found, strict=True)]

    def learn(self, units: list[str]) -> None:
        """Align distinct units.  Those whose pieces do not give their bytes become None."""
        b_ids = self.encode_b(units)
        raw = [u.encode("utf-8", "surrogatepass") for u in units]
        b = np.fromiter(chain.from_iterable(b_ids), np.int64)
        b_upto = np.cumsum([len(ids) for ids in b_ids])
        same_ends = (np.cumsum(self.b_lengths[b])[b_upto - 1] == np.cumsum([len(r) for r in raw])).all()
        if not same_ends or b"".join([self.b_bytes[i] for i in b.tolist()]) != b"".join(raw):
            fits = [
                b"".join([self.b_bytes[i] for i in ids]) == r for ids, r in zip(b_ids, raw, strict=True)
            ]
            odd = [u for u, fit in zip(units, fits, strict=True) if not fit]
            self.known.update(dict.fromkeys(odd))
            self.odd.update(odd)
            rest = [u for u, fit in zip(units, fits, strict=True) if fit]
            if rest:
                self.learn(rest)
            return
        a_ids = [self.encode_a(u) for u in units]
        a, a_upto = np.fromiter(chain.from_iterable(a_ids), np.int64), np.cumsum([len(ids) for ids in a_ids])
        a_ends, b_ends = np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
        ends = group_ends(a_ends, b_ends)
        rows, columns, _ = overlap_links(a_ends, b_ends)
        together, _, _ = group_links(a_ends, b_ends)
        # Tokens, groups and links before each unit's end.
        g_upto = np.searchsorted(ends, a_ends[a_upto - 1], "right")
        l_upto, t_upto = np.searchsorted(rows, a_upto), np.searchsorted(together, a_upto)
        pairs = ((a[rows] << 32) | b[columns]).tobytes()
        counts = [np.diff(upto, prepend=0).tolist() for upto in (a_upto, b_upto, g_upto, l_upto, t_upto)]
        texts = self._texts(a, b, np.searchsorted(ends, a_ends), np.searchsorted(ends, b_ends))
        i, k = 0, 0
        for unit, *n in zip(units, *counts, strict=True):
            i_to, k_to = i + n[0] + n[1], k + 8 * n[3]
            # The last mark is for another group to follow.
            self.known[unit] = Unit(*n, b"".join(texts[i:i_to])[:-1], pairs[k:k_to])
            i, k = i_to, k_to

    def _texts(self, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray) -> list[bytes]:
        """Tokens of both in the order of their groups, a's first, each with the mark that follows it."""
        at_a = np.arange(len(a)) + np.searchsorted(b_group, a_group)
        at_b = np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")
        out = np.empty(len(a) + len(b), object)
        for at, ids, group, mark, written in (
            (at_a, a, a_group, b"|", self.a_written),
            (at_b, b, b_group, b";", self.b_written),
        ):
            last = np.append(group[1:] != group[:-1], True)
            out[at] = np.where(last, written[mark][ids], written[b","][ids])
        return out.tolist()


def _squeezed(values: np.ndarray) -> bytes:
    """32-bit numbers, bytes of equal weight side by side, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _loose(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums over consecutive stretches."""
    upto = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return upto[ends] - upto[ends - lengths]


_COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_group_links")


def align_blocks(docs: DataFrame, ranks_path: str, pieces_path: str) -> DataFrame:
    """One row per block: its documents with their counts and units, its distinct id pairs with their counts."""
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    schema = pa.schema(
        [("block", pa.string()), ("docs", pa.binary())]
        + [(c, longs) for c in _COUNTS]
        + [("digests", pa.list_(pa.string())), ("n_units", longs), ("units", pa.binary())]
        + [("unit_links", pa.binary()), ("links", pa.binary()), ("a", ints), ("b", ints), ("n", longs)]
    )

    def block_row(aligner: Aligner, held: list[tuple]) -> pa.RecordBatch:
        fresh = list(dict.fromkeys(u for _, units in held for u in units if u not in aligner.known))
        for i in range(0, len(fresh), UNITS_AT_ONCE):
            aligner.learn(fresh[i : i + UNITS_AT_ONCE])
        if aligner.odd:
            held = [(doc, units if aligner.odd.isdisjoint(units) else []) for doc, units in held]
        places: dict[str, int] = {}
        at = [np.array([places.setdefault(u, len(places)) for u in units], np.int64) for _, units in held]
        known = [aligner.known[u] for u in places]
        texts = [u.groups for u in known]
        digests = [
            hashlib.sha256(b";".join([texts[i] for i in p.tolist()])).hexdigest() if len(p) else "" for p in at
        ]
        flat = np.concatenate(at)
        n_units = np.array([len(p) for p in at], np.int64)
        counts = []
        for c in _COUNTS:
            per_unit = np.array([getattr(u, c) for u in known], np.int64)
            counts.append(_sums(per_unit[flat], n_units).tolist())
        unit_links = np.array([u.n_links for u in known], np.int64)
        pairs, links = np.unique(
            np.frombuffer(b"".join([u.pairs for u in known]), np.int64), return_inverse=True
        )
        often = np.bincount(flat, minlength=len(known))
        n = np.bincount(links, np.repeat(often, unit_links), len(pairs)).astype(np.int64)
        columns = [uuid.uuid4().hex, pack_ids([doc for doc, _ in held]), *counts, digests, n_units.tolist()]
        columns += [_squeezed(flat), _squeezed(unit_links), _squeezed(links)]
        columns += [pairs >> 32, pairs & 0xFFFFFFFF, n]
        return pa.RecordBatch.from_arrays(
            [pa.array([c], f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(ranks_path, pieces_path)
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and size + len(text) > BLOCK_CHARS:
                    yield block_row(aligner, held)
                    held, size = [], 0
                    if len(aligner.known) > MOST_UNITS:
                        aligner.known.clear()
                        aligner.odd.clear()
                held.append((doc, aligner.units(text) if text else []))
                size += len(text)
        if held:
            yield block_row(aligner, held)

    arrays = ", ".join(f"{c} array<long>" for c in _COUNTS)
    return docs.mapInArrow(
        split,
        f"block string, docs binary, {arrays}, digests array<string>, n_units array<long>, units binary, "
        "unit_links binary, links binary, a array<int>, b array<int>, n array<long>",
    )


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, count, best): links per id pair over the corpus, and whether it is its b's highest count."""
    flat = blocks.select(F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select("p.*")
    counts = flat.groupBy("a", "b").agg(F.sum("n").alias("count"))
    highest = counts.groupBy("b").agg(F.max("count").alias("_highest"))
    return counts.join(highest, "b").select("a", "b", "count", (F.col("count") == F.col("_highest")).alias("best"))


def align_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks_path: str = RANKS,
    pieces_path: str = PIECES,
) -> DataFrame:
    """One row per document: (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_group_links).

    ``n_group_links`` counts the pairs of tokens that share a group.  Texts that are null or empty, or that the
    pieces do not give back byte by byte, have no tokens: zeros and an empty digest.  Repeated rows and null ids
    count and are returned like any other row; an empty table gives no rows; other columns are not looked at.
    A very long text is a block of its own, aligned in stretches of ``CHUNK_BYTES``.
    """
    blocks = stored(align_blocks(id_and_text(docs, id_col, text_col), ranks_path, pieces_path), "alignment")
    rated = pair_counts(blocks)
    asked = blocks.select(F.col("block").alias("of"), F.posexplode(F.arrays_zip("a", "b")).alias("at", "p"))
    answers = asked.select("of", "at", "p.*").join(rated, ["a", "b"]).select("of", "at", "count", "best")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links"]

    def add_up(held: pd.DataFrame, answer: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for row in held.itertuples():
            total, best = (np.zeros(len(answer), np.int64) for _ in range(2))
            total[answer["at"]], best[answer["at"]] = answer["count"], answer["best"]
            units, n_units = _loose(row.units), np.asarray(row.n_units, np.int64)
            links, unit_links = _loose(row.links), _loose(row.unit_links)
            sums = [_sums(_sums(per_pair[links], unit_links)[units], n_units) for per_pair in (best, total)]
            columns = [pd.array(unpack_ids(row.docs), "Int64"), *(getattr(row, c) for c in _COUNTS[:4]), *sums, row.digests, row.n_group_links]
            parts.append(pd.DataFrame(dict(zip(names, columns, strict=True))))
        return pd.concat(parts) if parts else pd.DataFrame(columns=names).astype({"doc_id": "Int64"})

    held = blocks.drop("a", "b", "n")
    return held.groupBy("block").cogroup(answers.groupBy("of")).applyInPandas(
        add_up,
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
        "groups_sha256 string, n_group_links long",
    )
