"""Where invoices come from and notifications go."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from storeflow.schemas import CORRUPT, IMPORT_INVOICE, empty
from storeflow.sources.files import Files

# Reading defaults of the purchase topic: only new messages, and go on after a gap.
_TOPIC_DEFAULTS = {"startingOffsets": "latest", "failOnDataLoss": "false"}


def import_schema() -> T.StructType:
    """Wire schema plus a column for documents that cannot be parsed."""
    return T.StructType([*IMPORT_INVOICE.fields, T.StructField(CORRUPT, T.StringType())])


def read_imports(spark: SparkSession, path: str) -> DataFrame:
    """All import invoices below a folder, one JSON object per line."""
    return spark.read.schema(import_schema()).json(path, columnNameOfCorruptRecord=CORRUPT)


def read_archived_imports(spark: SparkSession, inbox: str, archive: str) -> DataFrame:
    """All import invoices a stream with ``clean="archive"`` has or will have read, each file once.

    The archive keeps files below their whole old path.  The inbox is listed first: a file that is moved
    in between is found in both places and read from the archive.
    """
    files = Files(spark)
    live = files.below(inbox)
    moved = files.below(archive)
    # Ends with the folder the stream watches, then the file.
    watched = files.plain(inbox)
    archived = {f"/{f.path.split(watched.rstrip('/') + '/', 1)[1]}" for f in moved if watched in f.path}
    left = [f.path for f in live if f"/{f.path.split(watched.rstrip('/') + '/', 1)[1]}" not in archived]
    paths = left + [f.path for f in moved]
    if not paths:
        return empty(spark, import_schema())
    return spark.read.schema(import_schema()).json(paths, columnNameOfCorruptRecord=CORRUPT)


def read_import_stream(
    spark: SparkSession,
    path: str,
    max_files: int = 1,
    clean: str = "delete",
    archive_dir: str | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Watch a folder for import invoices.

    A batch takes ``max_files`` files or, where given, about ``max_bytes`` instead.
    ``clean`` says what happens to consumed files: ``delete``, ``archive`` (moved to
    ``archive_dir``) or ``off``.  Have one reader per folder unless it is ``off``.
    """
    if clean == "archive" and not archive_dir:
        raise ValueError("clean='archive' needs archive_dir")
    reader = (
        spark.readStream.format("json")
        .schema(import_schema())
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option(*(("maxBytesPerTrigger", max_bytes) if max_bytes else ("maxFilesPerTrigger", max_files)))
        .option("cleanSource", clean)
    )
    if archive_dir:
        reader = reader.option("sourceArchiveDir", archive_dir)
    return reader.load(path)


def read_purchase_stream(
    spark: SparkSession, servers: str, topic: str, options: dict[str, str] | None = None
) -> DataFrame:
    """Subscribe to the purchase topic.

    ``options`` adds to or overrides the defaults, for instance
    ``{"maxOffsetsPerTrigger": "500000"}`` to bound a batch.
    """
    settings = {
        "kafka.bootstrap.servers": servers, "subscribe": topic, **_TOPIC_DEFAULTS, **(options or {})
    }
    return spark.readStream.format("kafka").options(**settings).load()


def topic_sink(servers: str, topic: str) -> dict[str, str]:
    """Options of a stream that writes its ``value`` column to a topic."""
    return {"kafka.bootstrap.servers": servers, "topic": topic}
