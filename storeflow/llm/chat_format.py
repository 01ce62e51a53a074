"""Chat formatting at the level of tokens.

Each text is encoded by itself, and reserved ids, which no text can give, are spliced in around it; the loss mask follows
from prefix sums over the lengths of these segments.  Control strings that occur in a text are escaped before it is
encoded, so the decoded sequence can be read as a string too: ``[INST]`` becomes ``[\\INST]``, and what looks like an
escape gets one more backslash.

Turns are cut into sorted ranges, so a conversation of any length spreads over tasks, and none is held whole: it
leaves as pieces of about ``PIECE_TOKENS`` tokens, which follow each other by (part, piece).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby
from operator import itemgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeflow.llm.bpe import read_ranks
from storeflow.llm.common import partitions, stored

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
# Ids from here on are not in the vocabulary.
FIRST_RESERVED = 50_257
PIECE_TOKENS = 1 << 18
# A conversation with more text than this is digested from chunks.
CHUNK_BYTES = 1 << 20


@dataclass(frozen=True)
class Template:
    """How turns are marked.

    A turn of a role in ``wraps`` stands between two control strings of its own.  The ``answer`` role's text just ends
    with ``end``: it is what a model has to say.  Any other role is written out between the two strings of
    ``other``, and its turn ends with ``end`` as well.
    """

    wraps: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {"user": ("[INST]", "[/INST]"), "system": ("<<SYS>>", "<</SYS>>")}
    )
    other: tuple[str, str] = ("[ROLE]", "[/ROLE]")
    answer: str = "assistant"
    end: str = "</s>"

    def controls(self) -> list[str]:
        return [self.end, *self.other, *[c for pair in self.wraps.values() for c in pair]]

    def __post_init__(self):
        controls = self.controls()
        if len(set(controls)) < len(controls) or any(len(c) < 2 or "\\" in c for c in controls):
            raise ValueError("control strings must differ, have two characters or more and no backslash")
        # Then a string that holds control strings can be read in one way only.
        for c in controls:
            for i in range(1, len(c)):
                if any(c[i:].startswith(d) or d.startswith(c[i:]) for d in controls):
                    raise ValueError(f"the end of {c} can begin another control string")
        if any(c != d and c.startswith(d) for c in controls for d in controls):
            raise ValueError("one control string begins with another")


class Formatter:
    """Turns to ids and back."""

    def __init__(self, template: Template, ranks_path: str = RANKS, first_reserved: int = FIRST_RESERVED):
        self.template = template
        ranks = read_ranks(ranks_path)
        if max(ranks.values()) >= first_reserved:
            raise ValueError("reserved ids must lie above the vocabulary")
        encoding = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.encode, self.decode = encoding.encode_ordinary, encoding.decode_bytes
        self.first = first_reserved
        self.controls = template.controls()
        self.id_of = {c: first_reserved + i for i, c in enumerate(self.controls)}
        # What opens a turn, by id: its role and the id that closes it.
        self.opens = {self.id_of[a]: (role, self.id_of[b]) for role, (a, b) in template.wraps.items()}
        forms = [f"{re.escape(c[0])}%s{re.escape(c[1:])}" for c in self.controls]
        self.plain = re.compile("|".join(f % r"\\*" for f in forms))
        self.escaped = re.compile("|".join(f % r"\\+" for f in forms))

    def escape(self, text: str) -> str:
        return self.plain.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self.escaped.sub(lambda m: m[0][0] + m[0][2:], text)

    def segments(self, role: str, text: str) -> list[tuple[list[int], bool]]:
        """(ids, whether a model learns them) of one turn."""
        t = self.template
        said = self.encode(self.escape(text))
        if role == t.answer:
            return [(said, True), ([self.id_of[t.end]], False)]
        if role in t.wraps:
            before, after = t.wraps[role]
            return [([self.id_of[before]], False), (said, False), ([self.id_of[after]], False)]
        named = [self.id_of[t.other[0]], *self.encode(self.escape(role)), self.id_of[t.other[1]]]
        return [(named, False), (said, False), ([self.id_of[t.end]], False)]

    def text(self, ids: list[int]) -> str:
        """The formatted string."""
        out: list[str] = []
        for control, run in groupby(ids, key=lambda i: i >= self.first):
            if control:
                out += [self.controls[i - self.first] for i in run]
            else:
                out.append(self.decode(list(run)).decode("utf-8", "surrogatepass"))
        return "".join(out)

    def said(self, ids: list[int]) -> str:
        """A text as it was before it was escaped."""
        return self.unescape(self.decode(ids).decode("utf-8", "surrogatepass"))

    def turns(self, ids: np.ndarray) -> Iterator[tuple[str, str]]:
        """(role, text) read back from ids.  Reserved ids alone say where a turn begins and ends."""
        marks = np.flatnonzero(ids >= self.first)
        values = ids.tolist()
        end, (opens_name, closes_name) = self.id_of[self.template.end], [self.id_of[c] for c in self.template.other]
        at, k = 0, 0
        marked = marks.tolist()
        while at < len(values):
            role, closing = self.template.answer, end
            if values[at] == opens_name:
                if values[marked[k + 1]] != closes_name:
                    raise ValueError("a role is not closed")
                role = self.said(values[at + 1 : marked[k + 1]])
                at, k = marked[k + 1] + 1, k + 2
            elif values[at] in self.opens:
                role, closing = self.opens[values[at]]
                at, k = at + 1, k + 1
            if k == len(marked) or values[marked[k]] != closing:
                raise ValueError("a turn is not closed")
            yield role, self.said(values[at : marked[k]])
            at, k = marked[k] + 1, k + 1


def learned_runs(lengths: np.ndarray, learned: np.ndarray) -> np.ndarray:
    """Begin and end of each learned segment, by prefix sums over all segments' lengths: b0, e0, b1, e1, ..."""
    ends = np.cumsum(lengths)
    return np.stack([ends - lengths, ends], axis=1)[learned].ravel()


def loss_mask(runs: np.ndarray, n_tokens: int) -> np.ndarray:
    """One boolean per token: the prefix sum of +1 where a run begins and -1 where it ends."""
    steps = np.zeros(n_tokens + 1, np.int64)
    np.add.at(steps, runs[0::2], 1)
    np.add.at(steps, runs[1::2], -1)
    return np.cumsum(steps)[:n_tokens] > 0


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size_of, many: int = 1024, most: int = 8 << 20):
    """Batches of at most ``many`` rows, and not much more than ``most`` bytes."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if len(held) == many or size > most:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(zip(*rows, strict=True), schema, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=schema)


_PIECE = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int64()), ("piece", pa.int64()), ("n_turns", pa.int64())]
    + [("n_tokens", pa.int64()), ("ids", pa.binary()), ("loss_runs", pa.list_(pa.int64()))]
)


def format_conversations(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    template: Template | None = None,
    ranks_path: str = RANKS,
    piece_tokens: int = PIECE_TOKENS,
) -> DataFrame:
    """Pieces of formatted conversations: (conv_id, part, piece, n_turns, n_tokens, ids, loss_runs).

    ``ids`` are little-endian 32-bit numbers, ``loss_runs`` the begins and ends of what is learned of them.  A
    conversation's pieces follow each other by (part, piece); nearly all have one.  A piece holds whole turns and
    ends once it has ``piece_tokens`` tokens, so a very long text is a piece of its own.

    Turns come by number, those without one last; equal numbers by role, then text, and repeated rows are turns like
    others.  A null text or role is empty, rows without a conversation make up one with a null id, an empty table
    gives no pieces, and other columns are not looked at.
    """
    template = template or Template()
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("said"),
    )
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_last(), F.col("role")]

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter, part = Formatter(template, ranks_path), TaskContext.get().partitionId()

        def piece(conv: int | None, k: int, turns: list, segments: list[tuple[list[int], bool]]) -> tuple:
            lengths = np.array([len(ids) for ids, _ in segments], np.int64)
            runs = learned_runs(lengths, np.array([learned for _, learned in segments], bool))
            flat = np.array([i for ids, _ in segments for i in ids], "<u4")
            return conv, part, k, turns[0], len(flat), flat.tobytes(), runs.tolist()

        def pieces() -> Iterator[tuple]:
            for conv, found in groupby(_rows(batches), key=itemgetter(0)):
                segments, turns, tokens, k = [], [0], 0, 0
                for _, _, role, said in found:
                    new = formatter.segments(role, said)
                    segments += new
                    turns[0] += 1
                    tokens += sum(len(ids) for ids, _ in new)
                    if tokens >= piece_tokens:
                        yield piece(conv, k, turns, segments)
                        segments, turns, tokens, k = [], [0], 0, k + 1
                if segments:
                    yield piece(conv, k, turns, segments)

        return _batches(pieces(), _PIECE, lambda row: len(row[5]))

    return (
        rows.repartitionByRange(partitions(conversations.sparkSession), *order, F.substring("said", 1, 64))
        .sortWithinPartitions(*order, "said")
        .mapInArrow(
            assemble,
            "conv_id long, part long, piece long, n_turns long, n_tokens long, ids binary, loss_runs array<long>",
        )
    )


def formatted_text(
    pieces: DataFrame, template: Template | None = None, ranks_path: str = RANKS
) -> DataFrame:
    """(conv_id, part, piece, formatted): pieces as strings."""
    template = template or Template()
    schema = pa.schema([*list(_PIECE)[:3], ("formatted", pa.string())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter = Formatter(template, ranks_path)
        texts = ((*row[:3], formatter.text(np.frombuffer(row[3], "<u4").tolist())) for row in _rows(batches))
        return _batches(texts, schema, lambda row: len(row[3]))

    return pieces.select("conv_id", "part", "piece", "ids").mapInArrow(
        write, "conv_id long, part long, piece long, formatted string"
    )


_DIGEST = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string())]
    + [("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)
_CHUNK = pa.schema(
    [*_DIGEST, ("part", pa.int64()), ("chunk", pa.int64()), ("turns", pa.binary()), ("learned", pa.binary())]
)
_DIGEST_DDL = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def read_back(pieces: DataFrame, template: Template | None = None, ranks_path: str = RANKS) -> DataFrame:
    """Digests of conversations, from nothing but their pieces' ids and loss runs.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars): of role, newline, text, newline per
    turn, and of all text under the mask.  ``pieces`` must stand as :func:`format_conversations` leaves them: by
    conversation within sorted partitions.  A conversation that may go on in another partition, or is long, leaves its
    task as chunks of about ``CHUNK_BYTES``, which are hashed in order where they meet.
    """
    template = template or Template()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter = Formatter(template, ranks_path)

        def chunk(conv, part: int, k: int, counts: list[int], turns: bytearray, learned: bytearray) -> tuple:
            n_turns, loss, chars = counts
            return conv, n_turns, None, loss, None, chars, part, k, bytes(turns), bytes(learned)

        def whole(row: tuple) -> tuple:
            shas = [hashlib.sha256(row[i]).hexdigest() for i in (8, 9)]
            return *row[:2], shas[0], row[3], shas[1], row[5], None, None, None, None

        def found() -> Iterator[tuple]:
            first, waiting = True, None
            for conv, rows in groupby(_rows(batches), key=itemgetter(0)):
                if waiting:
                    yield whole(waiting)
                waiting, k = None, 0
                counts, turns, learned = [0, 0, 0], bytearray(), bytearray()
                for _, part, _, _, n, raw, runs in rows:
                    if len(turns) > CHUNK_BYTES:
                        yield chunk(conv, part, k, counts, turns, learned)
                        k, counts, turns, learned = k + 1, [0, 0, 0], bytearray(), bytearray()
                    ids, bounds = np.frombuffer(raw, "<u4"), np.array(runs, np.int64)
                    for role, said in formatter.turns(ids):
                        turns += f"{role}\n{said}\n".encode("utf-8", "surrogatepass")
                        counts[0] += 1
                    # Each run of the mask is one text, escaped by itself.
                    mask = loss_mask(bounds, n)
                    for begin, end in zip(bounds[0::2].tolist(), bounds[1::2].tolist(), strict=True):
                        said = formatter.said(ids[begin:end][mask[begin:end]].tolist())
                        learned += said.encode("utf-8", "surrogatepass")
                        counts[1] += len(said)
                    counts[2] += len(formatter.text(ids.tolist()))
                last = chunk(conv, part, k, counts, turns, learned)
                # The first conversation of a partition may have begun before, one cut already is in chunks.
                if first or k:
                    yield last
                else:
                    waiting = last
                first = False
            if waiting:
                yield waiting  # the last one may go on

        return _batches(found(), _CHUNK, lambda row: len(row[8] or b"") + len(row[9] or b""))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for conv, chunks in groupby(_rows(batches), key=itemgetter(0)):
                counts, shas = [0, 0, 0], [hashlib.sha256(), hashlib.sha256()]
                for _, n_turns, _, loss, _, chars, _, _, turns, learned in chunks:
                    counts = [a + b for a, b in zip(counts, (n_turns, loss, chars), strict=True)]
                    shas[0].update(turns)
                    shas[1].update(learned)
                yield conv, counts[0], shas[0].hexdigest(), counts[1], shas[1].hexdigest(), counts[2]

        return _batches(found(), _DIGEST, lambda row: 0)

    parts = stored(
        pieces.mapInArrow(digest, f"{_DIGEST_DDL}, part long, chunk long, turns binary, learned binary"), "chats"
    )
    done = parts.where("part IS NULL").select(*_DIGEST.names)
    chunks = parts.where("part IS NOT NULL").repartition("conv_id")
    return done.unionByName(
        chunks.sortWithinPartitions("conv_id", "part", "chunk").mapInArrow(join, _DIGEST_DDL)
    )
