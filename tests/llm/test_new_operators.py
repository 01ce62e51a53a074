"""Chat formatting, tokenizer alignment and the Merkle manifest against brute force, with nulls, ties and repeats."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from storeflow.llm import chat_format, merkle, queries, token_alignment
from storeflow.llm.chat_format import Formatter, Template
from storeflow.llm.token_alignment import Csr

RANDOM = random.Random(11)
CONTROLS = Template().controls()
PARTS = ["a", "the ", "  ", "\n", "[", "<", "\\", "INST]", "s>", "<<SYS>>", "[\\\\INST]", "é中", "\U0001f600", *CONTROLS]
ODD = "conv_id long, turn long, role string, text string, part long, ids string, said int, conv string"


def scrap(n: int) -> str:
    return "".join(RANDOM.choice(PARTS) for _ in range(n))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# Chat formatting


def test_escaping_is_reversible():
    formatter = Formatter(Template())
    for _ in range(3000):
        text = scrap(RANDOM.randint(0, 12))
        escaped = formatter.escape(text)
        assert formatter.unescape(escaped) == text
        assert not any(c in escaped for c in CONTROLS)


def test_turns_come_back_from_ids_and_from_the_string():
    formatter = Formatter(Template())
    names = "|".join(map(re.escape, CONTROLS))
    for _ in range(400):
        turns = [
            (RANDOM.choice(["user", "assistant", "system", "tool", "", "</s>", "[/ROLE]\n"]), scrap(RANDOM.randint(0, 8)))
            for _ in range(RANDOM.randint(1, 6))
        ]
        ids = [i for turn in turns for part, _ in formatter.segments(*turn) for i in part]
        assert list(formatter.turns(np.array(ids))) == turns
        text = formatter.text(ids)
        # Control strings in the string are just the reserved ids.
        assert [formatter.id_of[c] for c in re.findall(names, text)] == [i for i in ids if i >= formatter.first]


def test_templates_that_can_be_misread_are_refused():
    with pytest.raises(ValueError):
        Template(end="[INST]")
    with pytest.raises(ValueError):
        Template(end="x[")
    with pytest.raises(ValueError):
        Template(end="[INST]x")
    with pytest.raises(ValueError):
        Template(end="\\s")


def test_masks_from_prefix_sums():
    lengths, learned = np.array([1, 3, 0, 2, 1, 2]), np.array([False, True, True, False, False, True])
    runs = chat_format.learned_runs(lengths, learned)
    assert runs.tolist() == [1, 4, 4, 4, 7, 9]
    assert chat_format.loss_mask(runs, 9).tolist() == [False, True, True, True, False, False, False, True, True]


def expected_chats(rows):
    chats = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        chats[conv].append((turn is None, turn or 0, (role or "").encode(), (text or "").encode()))
    out = {}
    for conv, turns in chats.items():
        turns = [(role.decode(), text.decode()) for _, _, role, text in sorted(turns)]
        learned = [text for role, text in turns if role == "assistant"]
        out[conv] = (
            len(turns),
            sha("".join(f"{role}\n{text}\n" for role, text in turns)),
            sum(map(len, learned)),
            sha("".join(learned)),
        )
    return out


@pytest.mark.parametrize("small", [False, True])
def test_conversations_read_back(spark, small, monkeypatch):
    if small:
        monkeypatch.setattr(chat_format, "CHUNK_BYTES", 40)
    roles = ["user", "assistant", "system", "tool", None, "[ROLE]"]
    rows = [(conv, turn, RANDOM.choice(roles), scrap(RANDOM.randint(0, 9))) for conv in range(40) for turn in range(5)]
    rows += [(3, 2, "user", "tie"), (3, 2, "user", "tie"), (3, None, "assistant", "untimed"), (4, 1, "assistant", None)]
    rows += [(None, 1, "user", "no conversation"), (None, 2, "assistant", "x" * 50_000)]
    # One conversation with most rows.
    rows += [(7, k, RANDOM.choice(roles), scrap(6)) for k in range(5, 700)]
    df = spark.createDataFrame([(*r, 1, "i", 2, "c") for r in rows], ODD).repartition(5)
    pieces = chat_format.format_conversations(df, piece_tokens=60 if small else chat_format.PIECE_TOKENS)
    got = {r["conv_id"]: r for r in chat_format.read_back(pieces).collect()}
    want = expected_chats(rows)
    assert {k: tuple(r)[1:5] for k, r in got.items()} == want
    texts = defaultdict(int)
    for r in chat_format.formatted_text(pieces).collect():
        texts[r["conv_id"]] += len(r["formatted"])
    assert {k: r["formatted_chars"] for k, r in got.items()} == texts
    if small:
        assert pieces.where("conv_id = 7").count() > 20
        assert pieces.select("part").distinct().count() > 1


def test_no_conversations(spark):
    assert chat_format.read_back(chat_format.format_conversations(spark.createDataFrame([], ODD))).count() == 0


def test_op11_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    tricky = "</s>[INST] ok [/INST]"
    want = expected_chats([*rows, (-7, 0, "user", tricky), (-7, 1, "assistant", tricky)])
    got = {r["conv_id"]: tuple(r)[1:5] for r in queries.op11_chat_format(spark, folder).collect()}
    assert got == want


# Alignment


def dense(matrix: Csr) -> np.ndarray:
    out = np.zeros((len(matrix.indptr) - 1, matrix.columns), np.int64)
    np.add.at(out, (matrix.rows(), matrix.indices), 1)
    return out


@pytest.mark.parametrize("terms", [1, 7, 1 << 20])
def test_sparse_products(terms, monkeypatch):
    monkeypatch.setattr(token_alignment, "MOST_TERMS", terms)
    rng = np.random.default_rng(5)
    for _ in range(30):
        n, k, m = rng.integers(1, 9, 3)
        a, b = (
            Csr(np.concatenate([[0], np.cumsum(rows.sum(1))]), np.nonzero(rows)[1], rows.shape[1])
            for rows in (rng.integers(0, 2, (n, k)), rng.integers(0, 2, (k, m)))
        )
        assert (dense(a.transposed()) == dense(a).T).all()
        rows, columns, values = a.product(b)
        out = np.zeros((n, m), np.int64)
        out[rows, columns] = values
        assert (out == dense(a) @ dense(b)).all()


@pytest.mark.parametrize("chunk", [1, 50, 1 << 18])
def test_links(chunk, monkeypatch):
    monkeypatch.setattr(token_alignment, "CHUNK_BYTES", chunk)
    rng = np.random.default_rng(6)
    for _ in range(30):
        total = int(rng.integers(1, 300))
        a, b = (np.unique(np.append(rng.integers(1, total + 1, total // 3 + 1), total)) for _ in range(2))
        begins = [np.concatenate([[0], e[:-1]]) for e in (a, b)]
        overlap = np.minimum.outer(a, b) - np.maximum.outer(*begins)
        rows, columns, values = token_alignment.overlap_links(a, b)
        assert list(zip(rows, columns, values)) == [(i, j, overlap[i, j]) for i, j in np.argwhere(overlap > 0)]
        groups = [np.searchsorted(np.intersect1d(a, b), e) for e in (a, b)]
        rows, columns, _ = token_alignment.group_links(a, b)
        assert np.stack([rows, columns], 1).tolist() == np.argwhere(np.equal.outer(*groups)).tolist()


def byte_table() -> dict[str, int]:
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def aligned(texts: dict) -> tuple[dict, int]:
    """Brute force over whole texts with both libraries."""
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    table = byte_table()
    entry = {i: t for t, i in library.get_vocab().items()}
    found, counts = {}, Counter()
    for k, text in texts.items():
        found[k] = None
        if not text:
            continue
        a, b = library.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
        a_bytes = [bytes(table[c] for c in entry[i]) for i in a]
        b_bytes = [
            bytes([int(pieces.id_to_piece(i)[1:-1], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            continue
        ends = [np.cumsum([len(t) for t in side]) for side in (a_bytes, b_bytes)]
        begins = [np.concatenate([[0], e[:-1]]) for e in ends]
        overlap = np.minimum.outer(*ends) - np.maximum.outer(*begins)
        links = [(a[i], b[j]) for i, j in np.argwhere(overlap > 0).tolist()]
        cuts = np.intersect1d(*ends)
        sides = [np.split(ids, np.searchsorted(e, cuts, "right")[:-1]) for ids, e in zip((a, b), ends)]
        groups = ";".join("|".join(",".join(map(str, s)) for s in pair) for pair in zip(*sides))
        found[k] = (len(a), len(b), len(cuts), links, sha(groups), sum(len(x) * len(y) for x, y in zip(*sides)))
        counts.update(links)
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = {}
    for k, row in found.items():
        if row is None:
            out[k] = (0, 0, 0, 0, 0, 0, "", 0)
            continue
        n_a, n_b, n_groups, links, digest, shared = row
        best = sum(counts[p] == highest[p[1]] for p in links)
        out[k] = (n_a, n_b, n_groups, len(links), best, sum(counts[p] for p in links), digest, shared)
    return out, len(counts)


TEXTS = [
    None,
    "",
    " ",
    "  ",
    "a",
    "Plain words and more words.",
    "Plain words and more words.",
    "two  spaces\n\n  and lines \n x\t\ty  ",
    "<|endoftext|> </s> <s> <unk> <0x41>",
    "a mark ▁ of theirs",
    "café 中文 \U0001f600\U0001f600 ﬁ é  　 x\x1c y\x00z",
    "z" * 3_000,
    " ".join(["and"] * 2_000),
]


def documents(spark, texts):
    schema = "doc_id long, text string, block string, at long, n_units int, source string, lang string, n_chars long"
    return spark.createDataFrame([(k, t, "b", 1, 2, "s", None, 3) for k, t in texts], schema).repartition(3)


@pytest.mark.parametrize("block", [100, 4_000_000])
def test_alignment(spark, block, monkeypatch):
    monkeypatch.setattr(token_alignment, "BLOCK_CHARS", block)
    monkeypatch.setattr(token_alignment, "MOST_UNITS", 20)
    words = ["".join(RANDOM.choices("abcdefghé中'1", k=RANDOM.randint(1, 8))) for _ in range(80)]
    texts = dict(enumerate(TEXTS + [" ".join(RANDOM.choices(words, k=60)) + RANDOM.choice([" ", "\n", ""]) for _ in range(25)]))
    want, _ = aligned(texts)
    rows = token_alignment.align_documents(documents(spark, texts.items())).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == want
    assert len(rows) == len(texts)


def test_alignment_of_repeated_and_null_ids(spark):
    rows = [(1, "same words"), (1, "same words"), (1, "other"), (None, "same words"), (None, None)]
    want, _ = aligned({k: t for k, (_, t) in enumerate(rows)})
    got = token_alignment.align_documents(documents(spark, rows)).collect()
    assert Counter(map(tuple, got)) == Counter((doc, *want[k]) for k, (doc, _) in enumerate(rows))


def test_alignment_of_nothing(spark):
    assert token_alignment.align_documents(documents(spark, [])).count() == 0
    assert [tuple(r)[1:7] for r in token_alignment.align_documents(documents(spark, [(5, None)])).collect()] == [(0,) * 6]


# Merkle manifest


def h(*nodes: str) -> str:
    return sha("".join(nodes))


def framed(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, i):
    for level in levels[:-1]:
        run = i - i % 16
        yield level[run:i], level[i + 1 : run + 16]
        i //= 16


def proved(rows: list[tuple]) -> Counter:
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for row in rows:
        text = row[4]
        if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and text is not None:
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        leaf, changed = (h(*[framed(v) for v in (*row[:4], t)]) for t in (row[4], text))
        groups[row[1]].append(((row[0] is not None, row[0] or 0, leaf), row[0], leaf, changed))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    leaves = {s: sorted(groups[s]) for s in names}
    trees = {s: tree([x[2] for x in leaves[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    root, out = top[-1][0], Counter()
    for k, s in enumerate(names):
        for i, (_, doc, leaf, node) in enumerate(leaves[s]):
            path = [*siblings(trees[s], i), *siblings(top, k)]
            for left, right in path:
                node = h(*left, node, *right)
            proof = h(*[n for left, right in path for n in left + right])
            out[(doc, leaf, trees[s][-1][0], root, proof, node, node == root)] += 1
    return out


LEAVES = "doc_id long, source string, lang string, n_chars long, text string, tree string, pos long, hash string"


@pytest.mark.parametrize("every", [1, 2, 3])
def test_merkle_proofs(spark, every):
    rows = [(k, "big", "en", k % 7, f"Text {k}") for k in range(700)]
    rows += [(k, f"s{k % 20}", None, None, "A" * (k % 3)) for k in range(700, 1000)]
    rows += [(1, "one", "en", 1, "ALONE"), (2, None, "en", 1, None), (3, None, None, None, None), (4, "", "", 0, "")]
    rows += [(5, "big", "en", 5, "Other"), (5, "big", "en", 5, "Other"), (None, "big", None, None, "No id")]
    rows += [(k, "é\U0001f600", "en", 1, "X" * 9000) for k in range(17)] + [(9, "￿", "en", 1, "q")]
    docs = spark.createDataFrame([(*r, "t", 1, "h") for r in rows], LEAVES).repartition(6)
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    fields = [F.col(c) for c in merkle.FIELDS[:-1]] + [F.translate("text", merkle.UPPER, merkle.LOWER)]
    manifest = merkle.build_manifest(docs, carry={"tampered": F.when(changed, merkle.leaf_hash(fields))}, every=every)
    got = merkle.proofs(manifest, check="tampered").drop("tampered").collect()
    assert Counter(map(tuple, got)) == proved(rows)
    # Only every few levels are stored.
    assert [level.count() for level in manifest.groups.levels][0] == len(rows)
    assert len(manifest.groups.levels) == 1 + -(-3 // every)


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17])
def test_merkle_small(spark, n):
    rows = [(k, "s", "en", 1, "ABC") for k in range(n)]
    docs = spark.createDataFrame([(*r, "t", 1, "h") for r in rows], LEAVES)
    manifest = merkle.build_manifest(docs)
    got = merkle.proofs(manifest).collect()
    assert [r["verified"] for r in got] == [True] * n
    assert {r["root"] for r in got} == ({manifest.root} if n else set())
    assert (manifest.root is None) == (n == 0)


def test_op13_query(spark):
    folder = "/root/testdata/sf0.001"
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select(*columns).collect()]
    got = queries.op13_merkle_manifest(spark, folder).collect()
    assert Counter(map(tuple, got)) == proved(rows)


def test_op12_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    short = {r["doc_id"]: r["text"] for r in docs if len(r["text"] or "") < 4_000}
    every, _ = aligned({r["doc_id"]: r["text"] for r in docs if len(r["text"] or "") < 40_000})
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op12_token_alignment(spark, folder).collect()}
    assert len(got) == len(docs)
    # Counts over the corpus need all texts; very long ones make the dense brute force too large.
    if len(every) == len(docs):
        assert got == every
    else:
        assert {k: got[k][:4] for k in short} == {k: every[k][:4] for k in short}
