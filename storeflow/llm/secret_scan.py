"""Secret scans: all rules in one byte pass of a combined automaton."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeflow.llm.automaton import Automaton, build
from storeflow.llm.common import id_and_text


@dataclass(frozen=True)
class Rule:
    """``loose`` finds leftmost, non-overlapping matches; one counts if its ``group`` has ``least`` bytes.

    ``strict`` matches somewhere within every match that counts; it goes into the automaton.  Lengths are
    left to ``least`` where a rare beginning is enough: counters of several rules multiply the states.
    """

    kind: str
    loose: bytes
    strict: bytes
    group: int = 0
    least: int = 0


_ASSIGN = rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]%s)"""
BASE_RULES = (
    Rule("assign", _ASSIGN % b"+", _ASSIGN % b"{8}", 2, 8),
    Rule("access", rb"AKIA[A-Z0-9]+", rb"AKIA[A-Z0-9]", 0, 16),
    Rule("hex", rb"[0-9a-f]+", rb"[0-9a-f]{32}", 0, 32),
)
MORE_RULES = (
    Rule("private_key", rb"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----", rb"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----"),
    Rule("web_token", *[rb"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"] * 2),
    Rule("host_token", rb"gh[oprsu]_[A-Za-z0-9]+", rb"gh[oprsu]_[A-Za-z0-9]", 0, 34),
    Rule("chat_token", rb"xox[abprs]-[A-Za-z0-9-]+", rb"xox[abprs]-[A-Za-z0-9-]", 0, 15),
)
RULES = BASE_RULES + MORE_RULES
SPANS = "array<struct<kind:string,start:long,end:long>>"


def automaton(rules: tuple[Rule, ...]) -> Automaton:
    return build([rule.strict for rule in rules])


def find_spans(
    texts: list[str], rules: tuple[Rule, ...], machine: Automaton
) -> dict[int, list[tuple[int, int, int]]]:
    """Text number to (start, rule number, end) in bytes, in that order.  Texts without a secret are missing.

    The automaton reads the texts in one go and says behind which bytes a rule matches.  A match cannot
    reach across a byte that resets the automaton, so the exact spans of a rule are then taken from the stretch
    between the two resets around the hit, by the rule's loose form.
    """
    gap = int(np.flatnonzero(machine.resets)[0])
    pieces = [text.encode("utf-8", "surrogatepass") for text in texts]
    data = bytes([gap]).join([*pieces, b""])
    codes = np.frombuffer(data, np.uint8)
    begins = np.concatenate([[0], np.cumsum([len(p) + 1 for p in pieces])])
    where, what = machine.scan(codes)
    found: dict[int, list[tuple[int, int, int]]] = {}
    if not len(where):
        return found
    resets = np.flatnonzero(machine.resets[codes])
    nth = np.searchsorted(resets, where - 1)
    loose = [re.compile(rule.loose) for rule in rules]
    seen: set[tuple[int, int]] = set()
    for stretch, mask in zip(nth.tolist(), what.tolist(), strict=True):
        low = int(resets[stretch - 1]) + 1 if stretch else 0
        high = int(resets[stretch])
        for r, rule in enumerate(rules):
            if not mask >> r & 1 or (stretch, r) in seen:
                continue
            seen.add((stretch, r))
            text = int(np.searchsorted(begins, low, side="right")) - 1
            shift = low - int(begins[text])
            for m in loose[r].finditer(data[low:high]):
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    found.setdefault(text, []).append((m.start() + shift, r, m.end() + shift))
    for spans in found.values():
        spans.sort()
    return found


def in_characters(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The same spans counted in code points."""
    if text.isascii():
        return spans
    codes = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    before = np.concatenate([[0], np.cumsum((codes & 0xC0) != 0x80)])
    return [(int(before[a]), r, int(before[b])) for a, r, b in spans]


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """One row per document: (doc_id, spans), spans by start, then in the order of the rules.

    Offsets count code points; the end is exclusive.  Null and empty texts have no spans.  Repeated rows
    and null ids are scanned like any other row; other columns are not looked at.
    """

    machine = automaton(rules)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = find_spans(texts, rules, machine)
            spans = [
                [{"kind": rules[r].kind, "start": a, "end": b} for a, r, b in in_characters(t, found[k])]
                if k in found
                else []
                for k, t in enumerate(texts)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(kind))], ["doc_id", "spans"])

    return id_and_text(docs, id_col, text_col).mapInArrow(scan, f"doc_id long, spans {SPANS}")


def mask_secrets(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The same rows and columns with each secret replaced by ``[KIND]``; overlapping spans are replaced as one,
    under the kind of the first.  A null text stays null."""
    place = docs.columns.index(text_col)

    machine = automaton(rules)

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            found = find_spans([t or "" for t in texts], rules, machine)
            for k, spans in found.items():
                data, out, at = texts[k].encode("utf-8", "surrogatepass"), [], 0
                for a, r, b in spans:
                    if a >= at:
                        out += [data[at:a], b"[%s]" % rules[r].kind.upper().encode()]
                    at = max(at, b)
                texts[k] = b"".join([*out, data[at:]]).decode("utf-8", "surrogatepass")
            columns = list(batch.columns)
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.withColumn(text_col, F.col(text_col).cast("string")).mapInArrow(mask, docs.schema)


__all__ = ["BASE_RULES", "MORE_RULES", "RULES", "Rule", "find_spans", "mask_secrets", "scan_secrets"]
