"""One registered query per operator, over its whole table, and SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeflow.llm import quality_rules as rules
from storeflow.llm import (
    bpe,
    chat_format,
    jaccard_join,
    lm_scoring,
    merkle,
    nn_descent,
    packing,
    quality_classifier,
    secret_scan,
    substring_dedup,
    token_alignment,
    url_filter,
)
from storeflow.llm.common import table
from storeflow.llm.twins import chat_sql, merkle_sql


# A conversation whose texts are made of control strings.
TRICKY = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]


def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, folder, "documents"))


def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.resample(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_groups(table(spark, folder, "documents"))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, folder, "pages"))


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_documents(
        table(spark, folder, "documents"),
        result=bpe.digests(),
        result_schema="ids_sha256 string, decoded_sha256 string",
    )


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, folder, "documents"))
    base = [rule.kind for rule in secret_scan.BASE_RULES]

    def joined(spans):
        return F.array_join(
            F.transform(
                spans,
                lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
            ),
            ",",
        )

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in base],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.quality_rules(table(spark, folder, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "lost_chars",
        "kept",
    )


def op9_nn_descent(spark: SparkSession, folder: str) -> DataFrame:
    return nn_descent.nearest_neighbours(table(spark, folder, "embeddings"))


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, folder, "documents"))


def op11_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    chats = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(TRICKY, "conv_id long, turn long, role string, text string")
    return chat_format.read_back(chat_format.format_conversations(chats.unionByName(added)))


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.align_documents(table(spark, folder, "documents"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    # A fifth of the documents have their text lower-cased before they are checked.
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lower = {"text": F.translate("text", merkle.UPPER, merkle.LOWER)}
    tampered = merkle.leaf_hash([lower.get(f, F.col(f)) for f in merkle.FIELDS])
    manifest = merkle.build_manifest(docs, carry={"tampered": F.when(changed, tampered)})
    return merkle.proofs(manifest, check="tampered").select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_packing": op4_packing,
    "op5_url_filter": op5_url_filter,
    "op6_bpe": op6_bpe,
    "op7_secret_scan": op7_secret_scan,
    "op8_quality_rules": op8_quality_rules,
    "op9_nn_descent": op9_nn_descent,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_chat_format": op11_chat_format,
    "op12_token_alignment": op12_token_alignment,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_URL_RULES = {
    "example.net/en/": "h = 'example.net' OR h LIKE '%.example.net') AND starts_with(path, '/en/'",
    "example.com/de/": "h = 'example.com' OR h LIKE '%.example.com') AND starts_with(path, '/de/'",
    "org/fr/": "h = 'org' OR h LIKE '%.org') AND starts_with(path, '/fr/'",
    "net/": "h = 'net' OR h LIKE '%.net') AND starts_with(path, '/'",
}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_VERDICTS = {rule: verdict for verdict, rule in url_filter.BASE_RULES}

ORACLES: dict[str, str] = {
    "op5_url_filter": rf"""
WITH rest AS (
  SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS r FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS h,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), ruled AS (
  SELECT page_id, h AS host, path,
         CASE {" ".join(f"WHEN ({test}) THEN '{rule}'" for rule, test in _URL_RULES.items())} END AS rule,
         starts_with(path, '/') AND
           regexp_matches(h, '(^|\.)(ads-track|cheap-pills|free-bets)\.example\.(com|net|org)$') AS more
  FROM parts
)
SELECT page_id, host, path, rule,
       CASE {" ".join(f"WHEN rule = '{rule}' THEN '{_VERDICTS[rule]}'" for rule in _URL_RULES)}
            WHEN more THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN rule IS NULL AND more
            THEN regexp_extract(host, '(ads-track|cheap-pills|free-bets)\.example\.(com|net|org)$') || '/' END AS more_rule
FROM ruled
""",
    "op8_quality_rules": rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         string_split(coalesce(text, ''), chr(10)) AS lines,
         row_number() OVER () AS rid
  FROM documents
), grams AS (
  SELECT rid, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM split)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM grams) WHERE n > 1
), covered AS (
  SELECT rid, count(DISTINCT i + d) AS n FROM twice, (VALUES (0), (1), (2)) AS v(d) GROUP BY rid
), judged AS (
  SELECT rid, doc_id, text, len(words) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS full_lines,
         list_filter(lines, lambda x: NOT regexp_matches(x, '[^\x20\x09-\x0D]') OR (
           (regexp_matches(x, '{rules.SENTENCE_END.replace("'", "''")}')
             OR len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) <= {rules.SHORT_LINE})
           AND len(regexp_extract_all(x, '{rules.NAVIGATION}')) <= {rules.MAX_SEPARATORS}
           AND 100 * len(regexp_extract_all(x, '[#*$%&|<>]')) <= {rules.MAX_SYMBOLS} * length(x)
           AND NOT regexp_matches(x, '{rules.BOILERPLATE}'))) AS good_lines
  FROM split
), counted AS (
  SELECT j.*, coalesce(c.n, 0) AS n_repeat_words, len(full_lines) - len(list_distinct(full_lines)) AS n_dup_lines,
         word_chars - length(regexp_replace(array_to_string(good_lines, ' '), '[\x20\x09-\x0D]+', '', 'g')) AS lost_chars,
         n_words < {rules.MIN_WORDS} OR 100 * coalesce(c.n, 0) > {rules.MAX_REPEATED} * n_words AS base_failed
  FROM judged j LEFT JOIN covered c USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lost_chars,
       NOT base_failed AND 100 * lost_chars <= {rules.MAX_LOST} * word_chars AS kept
FROM counted
""",
    "op11_chat_format": chat_sql(TRICKY),
    "op13_merkle_manifest": merkle_sql(),
}
