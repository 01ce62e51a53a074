"""One deterministic automaton for many regular expressions, and a scan that runs it over many texts at once.

Patterns are read by Python's own regex parser.  Their automaton is built by subset
construction, unanchored (a match may begin at any byte), then minimised by
splitting classes of states until nothing changes.  What is left are two arrays:
the class of each byte, and the next state for each state and class.

Some bytes lead from every state to the start state.  No match contains such a
byte, so texts are cut behind them into lanes of about equal length, and numpy
takes one step in all lanes at a time: each byte is looked at once for all rules.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from re import _constants as C  # noqa: I001
from re import _parser

LANE = 4096


class _Nfa:
    """States with byte-set edges and empty edges."""

    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.edges: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.edges.append([])
        return len(self.empty) - 1

    def add(self, items: Sequence, at: int, fold: bool) -> int:
        """Append parsed items behind ``at``; returns where they end."""
        for op, arg in items:
            at = self._one(op, arg, at, fold)
        return at

    def _one(self, op, arg, at: int, fold: bool) -> int:
        if op in (C.LITERAL, C.NOT_LITERAL, C.IN, C.ANY):
            to = self.state()
            self.edges[at].append((_bytes(op, arg, fold), to))
            return to
        if op is C.SUBPATTERN:
            _, on, _, items = arg
            return self.add(items, at, fold or bool(on & re.IGNORECASE))
        if op is C.BRANCH:
            to = self.state()
            for items in arg[1]:
                begin = self.state()
                self.empty[at].append(begin)
                self.empty[self.add(items, begin, fold)].append(to)
            return to
        if op in (C.MAX_REPEAT, C.MIN_REPEAT):
            low, high, items = arg
            for _ in range(low):
                at = self.add(items, at, fold)
            to = self.state()
            if high is C.MAXREPEAT:
                begin = self.state()
                self.empty[at].append(begin)
                self.empty[begin].append(to)
                self.empty[self.add(items, begin, fold)].append(begin)
            else:
                self.empty[at].append(to)
                for _ in range(high - low):
                    at = self.add(items, at, fold)
                    self.empty[at].append(to)
            return to
        raise ValueError(f"not supported in a rule: {op}")


def _bytes(op, arg, fold: bool) -> frozenset[int]:
    if op is C.ANY:
        return frozenset(range(256)) - {10}
    if op in (C.LITERAL, C.NOT_LITERAL):
        found, negate = {arg}, op is C.NOT_LITERAL
    else:
        found, negate = set(), False
        for kind, x in arg:
            if kind is C.NEGATE:
                negate = True
            elif kind is C.LITERAL:
                found.add(x)
            elif kind is C.RANGE:
                found.update(range(x[0], x[1] + 1))
            else:
                raise ValueError(f"not supported in a class: {kind}")
    if fold:
        found |= {b ^ 32 for b in found if chr(b).isascii() and chr(b).isalpha()}
    return frozenset(range(256)) - found if negate else frozenset(found)


@dataclass(frozen=True)
class Automaton:
    classes: np.ndarray  # uint8[256]: class of a byte
    table: np.ndarray  # int32[states * classes]: next state, times the number of classes
    accepts: np.ndarray  # int64[states]: bit r is set where rule r has just matched
    first_accept: int  # states from here on, times the number of classes, accept
    resets: np.ndarray  # bool[256]: bytes that lead from everywhere to the start

    def scan(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position behind a match, rules matched there) for every place where one ends."""
        n = len(data)
        if not n:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        kinds = self.classes[data]
        cuts = np.flatnonzero(self.resets[data]) + 1
        at = np.searchsorted(cuts, np.arange(LANE, n, LANE))
        starts = np.unique(np.concatenate([[0], cuts[at[at < len(cuts)]]]))
        starts = starts[starts < n]
        lengths = np.diff(starts, append=n)
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        alive = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        state = np.zeros(len(starts), np.int64)
        where, what = [], []
        for step in range(int(lengths[0])):
            k = alive[step]
            if k < len(state):
                state, starts = state[:k], starts[:k]
            state = self.table[state + kinds[starts + step]]
            if state.max() >= self.first_accept:
                hit = np.flatnonzero(state >= self.first_accept)
                where.append(starts[hit] + step + 1)
                what.append(self.accepts[state[hit] // (len(self.table) // len(self.accepts))])
        if not where:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        where, what = np.concatenate(where), np.concatenate(what)
        order = np.argsort(where)
        return where[order], what[order]


def build(patterns: Sequence[bytes], most_states: int = 100_000) -> Automaton:
    """The minimal automaton of all patterns (at most 62), matching anywhere."""
    nfa = _Nfa()
    start, ends = nfa.state(), {}
    for rule, pattern in enumerate(patterns):
        parsed = _parser.parse(pattern)
        begin = nfa.state()
        nfa.empty[start].append(begin)
        ends[nfa.add(parsed, begin, bool(parsed.state.flags & re.IGNORECASE))] = rule

    labels = {label for edges in nfa.edges for label, _ in edges}
    signature: dict[tuple, int] = {}
    classes = np.array(
        [signature.setdefault(tuple(b in label for label in labels), len(signature)) for b in range(256)], np.uint8
    )
    width = len(signature)
    sample = [int(np.flatnonzero(classes == c)[0]) for c in range(width)]

    def closure(states: Iterator[int]) -> frozenset[int]:
        seen, todo = set(), list(states)
        while todo:
            if (s := todo.pop()) not in seen:
                seen.add(s)
                todo.extend(nfa.empty[s])
        return frozenset(seen)

    moves = [
        [{c for c in range(width) if sample[c] in label} for label, _ in edges] for edges in nfa.edges
    ]
    known = {closure([start]): 0}
    todo, steps = list(known), []
    for states in todo:
        reached: list[set[int]] = [{start} for _ in range(width)]
        for s in states:
            for (_, to), kinds in zip(nfa.edges[s], moves[s], strict=True):
                for c in kinds:
                    reached[c].add(to)
        row = []
        for targets in reached:
            to = closure(targets)
            if to not in known:
                known[to] = len(known)
                todo.append(to)
                if len(known) > most_states:
                    raise ValueError("the rules need too many states; split them")
            row.append(known[to])
        steps.append(row)
    table = np.array(steps, np.int64)
    accepts = np.array([sum({1 << ends[s] for s in states if s in ends}) for states in todo], np.int64)

    # Minimise: states of one class accept the same rules and lead to the same classes.
    _, group = np.unique(accepts, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([group, group[table]]), axis=0, return_inverse=True)
        if finer.max() == group.max():
            break
        group = finer
    one = np.unique(finer, return_index=True)[1]
    table, accepts = finer[table[one]], accepts[one]
    # The start comes first, accepting states last.
    order = np.lexsort([np.arange(len(one)) != finer[0], accepts != 0])
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    table, accepts = place[table[order]], accepts[order]
    first = int(np.count_nonzero(accepts == 0))
    return Automaton(
        classes, (table * width).astype(np.int32).ravel(), accepts, first * width, (table == 0).all(axis=0)[classes]
    )
