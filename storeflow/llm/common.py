"""What several operators share: input columns, shared tables, word splitting."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeflow.plans.lineage import fresh_folder

# White space that ends a word, as a Java and as a Python character class.
SPACE = r"\x20\x09-\x0D"


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (doc_id, text), whatever else the table holds; a null text is empty."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while f"_{name}" in taken:
        name = f"_{name}"
    return f"_{name}"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again: computed once, and no executor has to stay alive."""
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def groups_for(df: DataFrame, bytes_each: int) -> int:
    """How many groups to deal work to: as many as shuffle partitions, or as the size of the input asks for."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # A plan without statistics counts as endless, or as a part of that.
    return max(partitions(df.sparkSession), size // bytes_each if size < 1 << 52 else 0)


def words(text: str) -> list[bytes]:
    """Words of a text with A-Z lowered.  bytes.split() splits on just the six characters of ``SPACE``."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def pack_ids(ids: list[int | None]) -> bytes:
    """Ids of a block.  As a list with nulls they would reach pandas as floats, which long ids do not survive."""
    return np.array([0 if i is None else i for i in ids], "<i8").tobytes() + bytes(i is None for i in ids)


def unpack_ids(blob: bytes) -> list[int | None]:
    n = len(blob) // 9
    values = np.frombuffer(blob, "<i8", n).tolist()
    return [None if gone else value for value, gone in zip(values, blob[8 * n :], strict=True)]


def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of each Arrow batch of (doc_id, text)."""
    for batch in batches:
        yield batch.column(0).to_pylist(), batch.column(1).to_pylist()
