"""The interpolated score against counts in dictionaries and expectation-maximisation without a grid."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from storeflow.llm import lm_scoring

RANDOM = random.Random(23)
WORDS = ["".join(RANDOM.choices("abcde", k=RANDOM.randint(1, 4))) for _ in range(90)]
END = "\n"


def fold(k: int | None) -> int:
    return zlib.crc32(b"" if k is None else str(k).encode()) % 7


def tokens(text: str | None) -> list[str]:
    return [*(text or "").lower().split(), END]


def counted(texts) -> tuple[Counter, Counter]:
    one, two = Counter(), Counter()
    for found in texts:
        one.update(found)
        two.update(zip([END, *found], found))
    return one, two


def estimates(found, one, two) -> list[tuple[int, float, float]]:
    """(bucket of the context, pair estimate, word estimate) along a text."""
    n, out = sum(one.values()), []
    for before, word in zip([END, *found], found):
        seen = one[before]
        bucket = int(math.log2(seen)) + 1 if seen else 0
        out.append((bucket, two[before, word] / max(seen, 1), one[word] / max(n, 1)))
    return out


def fit(rows, vocabulary: int) -> np.ndarray:
    value = np.array([[a, b, 1 / (vocabulary + 1)] for _, a, b in rows])
    w = np.full(3, 1 / 3)
    for _ in range(lm_scoring.ROUNDS):
        share = value * w
        share /= share.sum(axis=1, keepdims=True)
        w = share.sum(axis=0) + [0, 0, 1]
        w /= w.sum()
    return w


@pytest.mark.parametrize(("steps", "repeats"), [(4096, 1), (4096, 3), (lm_scoring.STEPS, 1)])
def test_interpolated_score(spark, steps, repeats, monkeypatch):
    monkeypatch.setattr(lm_scoring, "STEPS", steps)
    chain = {w: RANDOM.choices(WORDS, k=4) for w in WORDS}
    rows = []
    for k in range(160):
        word, said = RANDOM.choice(WORDS), []
        for _ in range(RANDOM.randint(0, 60)):
            said.append(word.upper() if RANDOM.random() < 0.1 else word)
            word = RANDOM.choice(chain[word]) if RANDOM.random() < 0.8 else RANDOM.choice(WORDS)
        rows.append((k, " ".join(said)))
    rows += [(None, "no id here"), (7, None), (8, ""), (9, "x y z " * 50)]
    rows *= repeats
    df = spark.createDataFrame([(k, t, 1, "n") for k, t in rows], "doc_id long, text string, one int, words string").repartition(4)
    texts = [(k, tokens(t)) for k, t in rows]
    one, two = counted(t for k, t in texts if fold(k) != lm_scoring.HELD_OUT)
    kept = counted(t for k, t in texts if fold(k) not in (lm_scoring.HELD_OUT, lm_scoring.DELETED))
    learned = [r for k, t in texts if fold(k) == lm_scoring.DELETED for r in estimates(t, *kept)]
    whole = fit(learned, len(kept[0]))
    weights = {b: fit([r for r in learned if r[0] == b], len(kept[0])) for b in {r[0] for r in learned}}

    def score(found) -> float:
        total = 0.0
        for bucket, a, b in estimates(found, one, two):
            w = weights.get(bucket, whole)
            total += math.log10(w[0] * a + w[1] * b + w[2] / (len(one) + 1))
        return total

    want = sorted((k is None, k or 0, len(t), score(t)) for k, t in texts)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["score"]) for r in lm_scoring.score_documents(df).collect())
    assert [x[:3] for x in got] == [x[:3] for x in want]
    # Ratios are gathered in cells of a part of a power of two; with narrow cells nothing is left of that.
    off = [abs(x[3] - y[3]) / x[2] for x, y in zip(got, want)]
    assert max(off) < 0.001 if steps > 1000 else sum(off) / len(off) < 0.015
    # The mixture predicts held-out texts better than single words do.
    held = [r for r in lm_scoring.score_documents(df).collect() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
