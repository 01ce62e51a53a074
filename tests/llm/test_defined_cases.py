"""Null ids, repeated rows and ids, clashing column names, empty tables, long texts: every operator and stage."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from storeflow.llm import (
    bpe,
    jaccard_join,
    lm_scoring,
    nn_descent,
    packing,
    quality_classifier,
    quality_rules,
    secret_scan,
    substring_dedup,
    token_alignment,
    url_filter,
)
from storeflow.llm.shingles import mixed

RANDOM = random.Random(17)
WORDS = ["".join(RANDOM.choices("abcdefghij", k=RANDOM.randint(2, 7))) for _ in range(500)]
# Names that operators and stages use for columns of their own.
CLASHES = ["_gone", "_of", "_hash", "_spans", "_place", "deal", "block", "node", "same", "rep", "n", "keys", "text_hash"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)


def prose(n: int) -> str:
    return " ".join(RANDOM.choices(WORDS, k=n))


PASSAGE = prose(80)
FIRST, SECOND, COPY = prose(70), prose(75), prose(90)
ROWS = [
    (1, f"{prose(40)} {PASSAGE} {prose(30)}"),
    (2, f"{prose(20)} {PASSAGE} {prose(60)}"),
    (2, prose(7)),
    (2, prose(7) + " other"),
    (3, COPY),
    (3, COPY),
    (4, COPY),
    (5, FIRST),
    (5, SECOND),
    (6, SECOND),
    (7, FIRST),
    (None, COPY),
    (None, None),
    (8, None),
    (9, ""),
    (9, ""),
    (10, " \n\t "),
    (11, "y" * 300_000),
    (12, " ".join(WORDS[:3] * 4_000)),
    (-3, COPY + " more"),
]


def documents(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "en", "s", 1, *["c"] * len(CLASHES)) for i, t in rows], SCHEMA).repartition(3)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def ids(df) -> Counter:
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


ALL = Counter(i for i, _ in ROWS)
PER_ROW = {
    "op1": lambda spark, docs: lm_scoring.score_documents(docs),
    "op2": lambda spark, docs: quality_classifier.resample(docs, labels(spark, [(1, 1, 0), (3, 0, 1)])),
    "op3": lambda spark, docs: jaccard_join.jaccard_groups(docs),
    "op6": lambda spark, docs: bpe.encode_documents(docs),
    "op7": lambda spark, docs: secret_scan.scan_secrets(docs),
    "op8": lambda spark, docs: quality_rules.quality_rules(docs),
    "op12": lambda spark, docs: token_alignment.align_documents(docs),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_row(spark, name):
    assert ids(PER_ROW[name](spark, documents(spark))) == ALL
    assert PER_ROW[name](spark, documents(spark, [])).count() == 0


def test_packing_takes_every_row(spark):
    pieces = packing.pack_documents(documents(spark))
    assert ids(pieces.where("start = 0")) == ALL
    assert packing.pack_documents(documents(spark, [])).count() == 0


def test_urls(spark):
    schema = "page_id long, url string, html string, host string, path string, rule string, verdict string"
    rows = [(1, "http://a.example.net/en/x"), (1, "http://a.example.net/en/x"), (1, "http://b.org/fr/"), (None, None), (2, None), (3, ""), (4, "no scheme")]
    rows += [(5, "http://" + "a." * 5_000 + "net/" + "x" * 50_000)]
    pages = spark.createDataFrame([(*r, "h", "x", "x", "x", "x") for r in rows], schema)
    found = url_filter.filter_urls(pages).collect()
    assert Counter(r["page_id"] for r in found) == Counter(i for i, _ in rows)
    assert {r["verdict"] for r in found if r["page_id"] == 1} == {"allow"}
    assert next(r for r in found if r["page_id"] == 5)["verdict"] == "block"
    assert url_filter.filter_urls(spark.createDataFrame([], schema)).count() == 0


def test_links_of_all_texts_of_an_id(spark):
    """Rows with one id are one document: 5 is linked by either text."""
    groups = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_groups(documents(spark)).collect()}
    assert (groups[5], groups[6], groups[7]) == (5, 5, 5)
    assert groups[3] == groups[4] == groups[-3] == -3
    assert groups[None] is None and groups[8] == 8 and groups[9] == 9 and groups[10] == 10
    assert groups[1] == 1 and groups[2] == 2


@pytest.mark.parametrize("seed", range(3))
def test_groups_of_near_copies_without_a_common_centre(spark, seed):
    """Chains and stars of copies, repeated ids among them, against all pairs."""
    rng = random.Random(seed)
    texts, chain = [], prose(100).split()
    for _ in range(40):
        texts.append(" ".join(chain))
        for _ in range(rng.choice([1, 1, 2])):
            chain = list(chain)
            chain[rng.randrange(len(chain))] = rng.choice(WORDS)
    centre = prose(90).split()
    for _ in range(60):
        copy = list(centre)
        for _ in range(rng.randint(1, 5)):
            copy[rng.randrange(len(copy))] = rng.choice(WORDS)
        texts.append(" ".join(copy))
    rows = [(k if k % 9 else k // 2, t) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    sets = [(i, {tuple(t.split()[k : k + 3]) for k in range(len(t.split()) - 2)}) for i, t in rows]
    top = {i: i for i, _ in rows}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a][1] & sets[b][1])
            if 100 * common >= 90 * (len(sets[a][1]) + len(sets[b][1]) - common):
                x, y = sorted((find(sets[a][0]), find(sets[b][0])))
                top[y] = x
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_groups(documents(spark, rows)).collect()}
    assert got == {i: find(i) for i in got}


def test_filters_lose_no_link():
    """Parities never tell two sets further apart than they are."""
    rng = np.random.default_rng(3)
    for _ in range(200):
        common = rng.integers(1, 1 << 60, rng.integers(0, 60)).astype(np.uint64)
        sides = [np.unique(np.concatenate([common, rng.integers(1, 1 << 60, rng.integers(0, 30)).astype(np.uint64)])) for _ in range(2)]
        odd = [np.bincount((mixed(s) % np.uint64(256)).astype(np.int64), minlength=256) & 1 for s in sides]
        apart = len(np.setxor1d(*sides))
        assert (odd[0] ^ odd[1]).sum() <= apart


def test_passages_of_texts_that_share_an_id(spark):
    docs = documents(spark)
    for _ in range(3):
        found = substring_dedup.repeated_passages(docs.repartition(4))
        hits = [r for r in found.collect() if r["doc_id"] == 2 and r["first_doc_id"] == 1]
        assert len(hits) == 1 and hits[0]["end"] - hits[0]["start"] >= 80
        cut = substring_dedup.cut_passages(docs, found)
        assert cut.columns == docs.columns
        texts = defaultdict(list)
        for r in cut.collect():
            texts[r["doc_id"]].append(r["text"])
        assert sum(map(len, texts.values())) == len(ROWS)
        assert {t for t in texts[2] if t in (ROWS[2][1], ROWS[3][1])} == {ROWS[2][1], ROWS[3][1]}
        assert not any(PASSAGE in t for t in texts[2]) and PASSAGE in texts[1][0]
    assert substring_dedup.repeated_passages(documents(spark, [])).count() == 0


def test_neighbours_of_mixed_lengths_and_repeated_ids(spark):
    rng = np.random.default_rng(2)
    rows = [(k, rng.standard_normal(4).tolist()) for k in range(150)]
    rows += [(100 + k, rng.standard_normal(9).tolist()) for k in range(60)]
    rows += [(20, rng.standard_normal(4).tolist()), rows[40], rows[40], (300, [1.0, 2.0]), (None, [1.0] * 4), (7, [0.0] * 9)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, node int, q string")
    table = [(i, np.array(v)) for i, v in {(i, tuple(v)) for i, v in rows} if i is not None and any(v)]
    want = Counter()
    for i, v in table:
        if i % 20 == 0:
            near = sorted(((-float(v @ w), j) for j, w in table if j != i and len(w) == len(v)))[:20]
            want.update((i, k + 1, j, round(-s, 9)) for k, (s, j) in enumerate(near))
    got = Counter((r[0], r[1], r[2], round(r[3], 9)) for r in nn_descent.nearest_neighbours(df).collect())
    assert sum((got & want).values()) >= 0.9 * sum(want.values())
    assert Counter((q, r) for q, r, *_ in got.elements()) == Counter((q, r) for q, r, *_ in want.elements())
    nothing = spark.createDataFrame([], df.schema)
    assert nn_descent.nearest_neighbours(nothing).columns == ["query_id", "rank", "vec_id", "score"]


# Weights and sampling of op2


def test_weights_and_top_k(spark):
    rows = [(k, prose(RANDOM.randint(0, 40))) for k in range(120)] + [(None, prose(9)), (5, "another text")]
    marks = [(k, int(k % 3 > 0), 0) for k in range(0, 100)]
    buckets = 1 << 10
    judged = quality_classifier.resample(documents(spark, rows), labels(spark, marks), keep=30, buckets=buckets).collect()
    targets = set(quality_classifier.target_ids(labels(spark, marks)).tolist())
    grams = [next(iter(quality_classifier.hashed_ngrams([t], buckets))) for _, t in rows]
    counts = np.zeros((2, buckets))
    for (i, _), g in zip(rows, grams, strict=True):
        counts[1] += np.bincount(np.asarray(g, np.int64), minlength=buckets)
        if i in targets:
            counts[0] += np.bincount(np.asarray(g, np.int64), minlength=buckets)
    s = quality_classifier.SMOOTHING
    ratio = np.log(counts[0] + s) - np.log(counts[1] * counts[0].sum() / counts[1].sum() + s)
    want = Counter((i, len(g), round(float(ratio[np.asarray(g, np.int64)].sum()), 6)) for (i, _), g in zip(rows, grams, strict=True))
    assert Counter((r["doc_id"], r["n_ngrams"], round(r["log_weight"], 6)) for r in judged) == want
    best = sorted((r["gumbel_key"] for r in judged), reverse=True)[:30]
    assert sorted((r["gumbel_key"] for r in judged if r["kept"]), reverse=True) == best


@pytest.mark.parametrize("few", [200_000, 10])
def test_every_labelled_text_counts(spark, few, monkeypatch):
    monkeypatch.setattr(quality_classifier, "BROADCAST_ROWS", few, raising=False)
    marks = spark.range(210_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    judged = quality_classifier.resample(documents(spark, [(k, prose(20)) for k in range(300)]), marks).collect()
    # All texts are targets, so nothing tells target and raw text apart.
    assert len(judged) == 300 and all(abs(r["log_weight"]) < 1e-9 for r in judged)


# The pipeline


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.fixture
def folder(spark, tmp_path):
    labels(spark, [(1, 1, 0), (3, 1, 0)]).write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_quality_goes_by_row(spark, folder, monkeypatch):
    docs = documents(spark)
    judged = quality_classifier.resample(docs, labels(spark))
    bad = {(2, ROWS[2][1]), (3, COPY), (None, None), (9, "")}
    marked = judged.withColumn("kept", F.lit(True))
    hashes = {(r["doc_id"], r["text"] or ""): r["h"] for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    for i, t in bad:
        hit = F.col("doc_id").eqNullSafe(F.lit(i)) & (F.col("text_hash") == hashes[(i, t or "")])
        marked = marked.withColumn("kept", F.col("kept") & ~hit)
    monkeypatch.setattr(quality_classifier, "resample", lambda *_: marked)
    left = stage("quality")(spark, docs, folder)
    assert left.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter(
        r for r in ROWS if r not in bad or r[0] is None
    )


def test_one_of_each_group_stays(spark, folder):
    docs = documents(spark)
    left = stage("near_duplicates")(spark, docs, folder)
    assert left.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in left.collect())
    gone = {(3, COPY), (4, COPY), (6, SECOND), (7, FIRST)}
    want = Counter({r: 1 if r[0] is not None else n for r, n in Counter(ROWS).items() if r not in gone})
    assert got == want


@pytest.mark.parametrize("name", ["repeated_passages", "secrets"])
def test_stages_keep_rows(spark, folder, name):
    docs = documents(spark)
    out = stage(name)(spark, docs, folder)
    assert out.columns == docs.columns and out.schema == docs.schema
    assert ids(out) == ALL


def test_pipeline_on_everything_and_nothing(spark, tmp_path):
    for name, rows in (("some", ROWS), ("none", [])):
        base = tmp_path / name
        documents(spark, rows).write.parquet(str(base / "documents.parquet"))
        labels(spark, [(1, 1, 0), (3, 1, 0)] if rows else []).write.parquet(str(base / "labels.parquet"))
        pieces = corpus_pipeline.run(spark, str(base)).collect()
        assert bool(pieces) == bool(rows)
        if rows:
            assert {1, 2, 5, -3, None} <= {r["doc_id"] for r in pieces}
            assert 4 not in {r["doc_id"] for r in pieces}


@pytest.mark.parametrize("name", ["op1", "op2", "op3", "op6", "op7", "op8", "op12"])
def test_long_ids_beside_null_ids(spark, name):
    """Ids that a float cannot hold, in a block with a row without one."""
    rows = [((1 << 62) + k, f"{prose(12)} {k}") for k in range(6)] + [(None, prose(5))]
    assert ids(PER_ROW[name](spark, documents(spark, rows).coalesce(1))) == Counter(i for i, _ in rows)
