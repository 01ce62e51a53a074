"""Where intermediate results are written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in ``spark.checkpoint.dir``.

    Only a local session may go without; it gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder:
        return folder
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="storeflow-")
    sc.setCheckpointDir(folder)
    return folder


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def freeze(df: DataFrame) -> DataFrame:
    """Compute once into the shared folder and read from there afterwards.

    Needed where rows carry a value a second run could assign differently.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
