"""URL filters: a broadcast trie over reversed host labels and path segments.

A rule is a host (it fits the host and every subdomain) and the beginning of a path.
The trie's first levels are host labels from the last to the first, its further
levels whole path segments; what a rule has after its last slash is compared as the
beginning of the next segment.  The longest match wins: more host labels first, then
the longer path.  Block and allow entries stand in one trie, so precedence between
them is by length alone; a rule given twice keeps its first verdict.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# (verdict, host and path).
BASE_RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
# Asked only where no base rule fits.
MORE_RULES = tuple(
    ("block", f"{name}.example.{top}/")
    for name in ("ads-track", "cheap-pills", "free-bets")
    for top in ("com", "net", "org")
)
OTHERWISE = "allow"
# A trie is sent to every executor, so the rule list has a bound.
MAX_RULES = 1_000_000


def build_trie(rules: Iterable[tuple[str, str]]) -> dict:
    """Nested plain dictionaries: a node has further labels, path segments, and tails with (rule, verdict)."""
    root = _node()
    for count, (verdict, rule) in enumerate(rules):
        if count >= MAX_RULES:
            raise ValueError(f"more than {MAX_RULES} rules: join them by host instead of broadcasting")
        host, slash, path = rule.partition("/")
        node = root
        for label in reversed(host.lower().split(".")):
            node = node["labels"].setdefault(label, _node())
        *segments, tail = (slash + path).split("/")
        for segment in segments:
            node = node["segments"].setdefault(segment, _node())
        node["tails"].setdefault(tail, (rule, verdict))
    return root


def _node() -> dict:
    return {"labels": {}, "segments": {}, "tails": {}}


def longest_match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """(rule, verdict) of the longest match."""
    node, best = trie, None
    segments = path.split("/")
    for label in reversed(host.split(".")):
        node = node["labels"].get(label)
        if node is None:
            break
        below = node
        for k, segment in enumerate(segments):
            fitting = [tail for tail in below["tails"] if segment.startswith(tail)]
            if fitting:
                best = below["tails"][max(fitting, key=len)]
            # A rule's segment ends with a slash, so the url's must too.
            if k + 1 == len(segments) or (below := below["segments"].get(segment)) is None:
                break
    return best


def filter_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: tuple[tuple[str, str], ...] = BASE_RULES,
    more_rules: tuple[tuple[str, str], ...] = MORE_RULES,
    otherwise: str = OTHERWISE,
) -> DataFrame:
    """One row per page: (page_id, host, path, rule, verdict, more_rule).

    ``rule`` is the fitting entry of ``rules``; without one it is null and the verdict is that
    of ``more_rules`` (then named in ``more_rule``) or else ``otherwise``.  Null urls and urls
    without ``://`` have an empty host and path, so no rule fits.  Repeated rows and null ids
    are judged like any other row; other columns of the table are not looked at.
    """
    spark = pages.sparkSession
    tries = spark.sparkContext.broadcast((build_trie(rules), build_trie(more_rules)))
    rest = F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    parts = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.translate(
            F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
        ).alias("host"),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path"),
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, more = tries.value
        for batch in batches:
            rule, verdict, other = [], [], []
            for host, path in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                found = longest_match(base, host, path)
                extra = None if found else longest_match(more, host, path)
                rule.append(found[0] if found else None)
                other.append(extra[0] if extra else None)
                verdict.append((found or extra or (None, otherwise))[1])
            arrays = [*batch.columns, *(pa.array(x, pa.string()) for x in (rule, verdict, other))]
            yield pa.RecordBatch.from_arrays(arrays, ["page_id", "host", "path", "rule", "verdict", "more_rule"])

    return parts.mapInArrow(
        judge, "page_id long, host string, path string, rule string, verdict string, more_rule string"
    )
