"""From raw documents to packed training sequences.

Five stages, each over everything its predecessor kept; between stages the documents are written as Parquet
to the shared folder.  Stages keep the columns of ``documents``, whatever they are; the last returns packed pieces.

What all stages have in common: a null text is an empty one where it is judged, and stays null; very long texts are
taken whole; an empty table stays empty.  Rows that share an id are judged each by its own text, but for
``near_duplicates``, where they are one document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storeflow.llm import jaccard_join, packing, quality_classifier, secret_scan, substring_dedup
from storeflow.llm.common import stored, table, unused

# Near duplicates are found on five words and a similarity of 0.8.
WIDTH = 5
PERCENT = 80


def _text_hash(docs: DataFrame):
    return F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps.

    A row goes if its own text is rejected, whatever else shares its id; equal rows go together.  Null and empty
    texts have weight 0 and stay, as do rows with a null id.
    """
    judged = quality_classifier.resample(docs, table(spark, sf_dir, "labels"))
    gone, of = unused(docs, "gone"), unused(docs, "of")
    rejected = judged.where("NOT kept AND doc_id IS NOT NULL")
    rejected = rejected.select(F.col("doc_id").alias(gone), F.col("text_hash").alias(of)).distinct()
    return docs.join(rejected, (docs["doc_id"] == F.col(gone)) & (_text_hash(docs) == F.col(of)), "left_anti")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id, and of equal rows one.

    Rows that share an id stay or go together.  Rows with a null id, and texts without words, are linked with nothing
    and stay.
    """
    groups = stored(jaccard_join.jaccard_groups(docs, width=WIDTH, percent=PERCENT), "groups")
    gone, place = unused(docs, "gone"), unused(docs, "place")
    losers = groups.where("component_id < doc_id").select(F.col("doc_id").alias(gone)).distinct()
    docs = docs.join(losers, docs["doc_id"] == F.col(gone), "left_anti")
    again = groups.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(gone)).count().where("count > 1")
    repeated = stored(again.select(gone), "repeated")
    if repeated.isEmpty():
        return docs
    several = docs.join(repeated, docs["doc_id"] == F.col(gone), "left_semi")
    # Equal texts of one id: one stays, the first in each task goes on.
    order = Window.partitionBy("doc_id", _text_hash(several)).orderBy("text")
    one = several.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place)
    return docs.join(repeated, docs["doc_id"] == F.col(gone), "left_anti").unionByName(one)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that a document before them (by id, then text) holds as well.

    Rows with a null id and null texts stay as they are.
    """
    return substring_dedup.cut_passages(docs, substring_dedup.repeated_passages(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked; null texts stay null."""
    return secret_scan.mask_secrets(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in packed sequences; a null text is just the end id."""
    return packing.pack_documents(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("secrets", secrets),
    ("sequences", sequences),
]
# Trained, hashed and tokenized rows: no SQL gives them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
