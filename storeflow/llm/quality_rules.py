"""Quality rules: line-first cleaning with built-in functions only.

Each line is judged by itself: it must end like a sentence, must not look like navigation, and must not
hold boilerplate.  Lines that fail are removed; a document that loses too much of its text is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storeflow.llm.common import SPACE, id_and_text

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
# Ends of sentences, also behind closing quotes and brackets.
SENTENCE_END = r"""[.!?…。！？:;]["'”’»)\]]*[\x20\x09-\x0D]*$"""
# Separators between the entries of a menu.
NAVIGATION = r"[|»›•·>]"
BOILERPLATE = (
    r"(?i)\b(cookie policy|privacy policy|terms of (use|service)|all rights reserved|enable javascript"
    r"|lorem ipsum|sign up|log in|subscribe now|click here|read more|share on)\b"
)
MIN_WORDS = 50
MAX_REPEATED = 50  # percent of the words
MAX_SEPARATORS = 3  # in one line
MAX_SYMBOLS = 10  # percent of a line's characters
SHORT_LINE = 4  # words; shorter lines may end in any way (headings)
MAX_LOST = 50  # percent of the word characters


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def without_spaces(text: Column) -> Column:
    return F.translate(text, SPACES, "")


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def repeated_words(words: Column) -> Column:
    """Words that stand in a window of three words found twice or more.

    Windows are compared by a 64-bit hash.  Where all are different (a hash set tells) nothing more is
    done; else windows are sorted with their places and the covered places are counted: n log n for any text.
    """
    hashes = F.when(
        F.size(words) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))

    def places(found: Column) -> Column:
        by_hash = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return bind(
            by_hash,
            lambda z: F.sort_array(
                F.filter(
                    F.transform(
                        z,
                        lambda e, i: F.when(
                            (F.coalesce(F.get(z, i - 1)["h"] == e["h"], F.lit(False)))
                            | (F.coalesce(F.get(z, i + 1)["h"] == e["h"], F.lit(False))),
                            e["i"],
                        ),
                    ),
                    lambda p: p.isNotNull(),
                )
            ),
        )

    def covered(found: Column) -> Column:
        return bind(
            places(found),
            lambda p: F.aggregate(
                F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))),
                F.lit(0),
                lambda a, x: a + x,
            ),
        )

    return bind(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)),
    ).cast("long")


def line_passes(line: Column) -> Column:
    separators = F.size(F.regexp_extract_all(line, F.lit(NAVIGATION), F.lit(0)))
    return (
        (line.rlike(SENTENCE_END) | (F.size(split_words(line)) <= SHORT_LINE))
        & (separators <= MAX_SEPARATORS)
        & (100 * (F.length(line) - F.length(F.translate(line, SYMBOLS, ""))) <= MAX_SYMBOLS * F.length(line))
        & ~line.rlike(BOILERPLATE)
    )


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts, base_failed, lost_percent, cleaned_text and kept.

    Null and empty texts have no words: base_failed, not kept.  Repeated rows and null ids are judged like any
    other row; other columns are not looked at.  Lines without a word are layout and never removed.
    """
    text = F.col("text")
    counted = id_and_text(docs, id_col, text_col).select(
        "doc_id",
        "text",
        split_words(text).alias("words"),
        F.split(text, "\n").alias("lines"),
    )
    counted = counted.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(without_spaces(text)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        bind(
            F.filter("lines", lambda x: without_spaces(x) != ""),
            lambda x: F.size(x) - F.size(F.array_distinct(x)),
        ).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.array_join(
            F.filter("lines", lambda x: (without_spaces(x) == "") | line_passes(x)), "\n"
        ).alias("cleaned_text"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    kept_chars = F.length(without_spaces(F.col("cleaned_text")))
    return counted.withColumn("base_failed", failed).withColumn(
        "lost_chars", (F.col("word_chars") - kept_chars).cast("long")
    ).withColumn("kept", ~failed & (100 * F.col("lost_chars") <= MAX_LOST * F.col("word_chars")))
