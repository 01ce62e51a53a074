"""SQL twins of op11 and op13."""

from __future__ import annotations

from storeflow.llm import chat_format, merkle

# Levels above the leaves that the SQL of op13 unrolls: 16 ** 6 leaves of a source, and as many sources.
LEVELS = 6


def framed(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bit = (
        "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), "
        "lambda r, z: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)"
    )
    codes = f"list_transform(string_split({text}, ''), lambda d: CAST(ascii(d) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda c, b: {bit}), 4294967295)"


def _levels(name: str, key: str) -> list[str]:
    """From nodes ``<name>0`` (key, pos, h, n) to the tops, with what stands left and right of a node in its run."""
    run = f"PARTITION BY {key}, pos // {merkle.FAN} ORDER BY pos ROWS BETWEEN"
    out = []
    for k in range(LEVELS + 1):
        out.append(f"""{name}{k}s AS (
  SELECT *, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
         coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
  FROM {name}{k} WHERE n > 1)""")
        out.append(f"""{name}{k + 1} AS (
  SELECT {key}, pos // {merkle.FAN} AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h,
         (any_value(n) + {merkle.FAN - 1}) // {merkle.FAN} AS n
  FROM {name}{k} WHERE n > 1 GROUP BY {key}, pos // {merkle.FAN})""")
    ends = " UNION ALL ".join(f"SELECT {key}, h FROM {name}{k} WHERE n = 1" for k in range(LEVELS + 2))
    return [*out, f"{name}tops AS ({ends})"]


def _climb(name: str, key: str, rows: str, step: str) -> list[str]:
    """From ``rows`` (key, pos, node, proof) up through the levels of ``name``; the last is ``<step><LEVELS>``."""
    out = []
    for k in range(LEVELS + 1):
        out.append(f"""{step}{k} AS (
  SELECT p.* EXCLUDE (pos, node, proof), p.pos // {merkle.FAN} AS pos,
         CASE WHEN s.h IS NULL THEN p.node ELSE sha256(s.lft || p.node || s.rgt) END AS node,
         p.proof || coalesce(s.lft || s.rgt, '') AS proof
  FROM {rows} p LEFT JOIN {name}{k}s s ON p.{key} = s.{key} AND p.pos = s.pos)""")
        rows = f"{step}{k}"
    return out


def merkle_sql() -> str:
    head = " || ".join(framed(c) for c in merkle.FIELDS[:-1])
    lowered = f"translate(text, '{merkle.UPPER}', '{merkle.LOWER}')"
    parts = [
        f"""hashed AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, sha256({head} || {framed("text")}) AS leaf,
         CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0 THEN sha256({head} || {framed(lowered)}) END AS changed
  FROM documents)""",
        """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n
  FROM hashed)""",
        "g0 AS (SELECT tree, pos, leaf AS h, n FROM ranked)",
        *_levels("g", "tree"),
        """t0 AS (
  SELECT 0 AS whole, row_number() OVER (ORDER BY tree) - 1 AS pos, h, count(*) OVER () AS n, tree FROM gtops)""",
        *_levels("t", "whole"),
        """low AS (
  SELECT doc_id, tree, leaf, pos, coalesce(changed, leaf) AS node, '' AS proof FROM ranked)""",
        *_climb("g", "tree", "low", "p"),
        f"""high AS (
  SELECT p.doc_id, p.leaf, t.h AS subroot, 0 AS whole, t.pos, p.node, p.proof FROM p{LEVELS} p JOIN t0 t ON p.tree = t.tree)""",
        *_climb("t", "whole", "high", "q"),
    ]
    return f"""
WITH {", ".join(parts)}
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = r.h AS verified
FROM q{LEVELS} q JOIN ttops r ON q.whole = r.whole"""


def _escaped_length(text: str, controls: list[str]) -> str:
    """One backslash more for each control string or escape of one."""

    def quoted(char: str) -> str:
        return f"[{char}]" if char not in "[]" else f"\\{char}"

    forms = "|".join(f"{quoted(c[0])}\\\\*{''.join(map(quoted, c[1:]))}" for c in controls)
    return f"(length({text}) + len(regexp_extract_all({text}, '{forms}')))"


def chat_sql(added: list[tuple[int, int, str, str]]) -> str:
    """The conversations and rows ``added`` to them."""
    t = chat_format.Template()
    said = _escaped_length("text", t.controls())
    cases = [f"WHEN '{t.answer}' THEN {said} + {len(t.end)}"]
    cases += [f"WHEN '{role}' THEN {said} + {len(a) + len(b)}" for role, (a, b) in t.wraps.items()]
    other = f"{said} + {_escaped_length('role', t.controls())} + {sum(map(len, (*t.other, t.end)))}"
    more = " UNION ALL ".join(f"SELECT {c}, {n}, '{role}', '{text}'" for c, n, role, text in added)
    order = "ORDER BY turn NULLS LAST, role, text"
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL {more})
), chats AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' {order}) AS said,
         coalesce(string_agg(text, '' {order}) FILTER (WHERE role = '{t.answer}'), '') AS learned,
         CAST(sum(CASE role {" ".join(cases)} ELSE {other} END) AS BIGINT) AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
       formatted_chars
FROM chats"""
