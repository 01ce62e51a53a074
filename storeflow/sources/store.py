"""Table stores.

``batch(source, batch_id)`` opens one micro-batch of one stream; what is appended to it, to however many tables, becomes
visible together when it closes.  ``append(df, table, source, batch_id)`` is a batch of one table, ``read(table)`` returns
a table.  Writing the same batch again leaves the tables as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeflow.schemas import LAYOUT, SERIAL_COLUMNS, TABLES, empty
from storeflow.sources.commits import CommitLog, Part
from storeflow.sources.files import Files
from storeflow.sources.reservations import TOTALS, newest_total

# Source of rows that stock snapshots write.
SNAPSHOTS = "snapshots"
# Source of facts put into folders by day.
LAYOUTS = "layouts"
# Copies that compaction runs at a time.
COPIES = 8

_BATCH = [T.StructField("source", T.StringType()), T.StructField("batch_id", T.LongType())]


class Batch:
    """One micro-batch being written.  ``append`` may be called from several threads."""

    def __init__(self, store: ParquetStore, source: str, batch_id: int):
        self.store, self.source, self.batch_id = store, source, batch_id
        # Whether rows are brought together into few files first; a batch of large partitions need not be.
        self.gather = True
        self._parts: dict[str, Part] = {}
        self._lock = Lock()

    def append(self, df: DataFrame, table: str) -> DataFrame:
        """Write into a folder of this attempt's own, in as few files as the size allows, or one for each partition
        of a large batch.

        Returns what was written, read back.
        """
        path = f"{table}/source={self.source}/batch_id={self.batch_id}/a-{uuid.uuid4().hex}"
        seen = Observation()
        # Counted where files are written, so a repeated stage before that counts once.
        rows = df.select(*TABLES[table].fieldNames())
        folder, order = LAYOUT.get(table, (None, None))
        # A folder's rows come together in one task, or several if they are many, and are sorted there.
        if folder:
            rows = rows.hint("rebalance", folder).sortWithinPartitions(folder, order)
        elif self.gather:
            rows = rows.hint("rebalance")
        writer = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write
        (writer.partitionBy(folder) if folder else writer).parquet(f"{self.store.root}/{path}")
        part = Part(self.source, self.batch_id, table, path, seen.get.get("rows", 0))
        with self._lock:
            self._parts[table] = part
        return self.store.rows_of([part], table).drop("source", "batch_id")

    def commit(self) -> None:
        """Tables this attempt has not written keep what an earlier one of the same batch wrote."""
        kept = {p.table: p for p in self.store.log.of(self.source, self.batch_id)}
        self.store.log.commit(self.source, self.batch_id, list((kept | self._parts).values()))


class ParquetStore:
    """Tables as Parquet below one folder, a folder per stream, batch and attempt.

    Only folders named by the log of finished batches are read.  A batch that fails halfway is not there for any table,
    and one that runs again replaces exactly what it wrote, also when it has become empty.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/_commits", self._texts)

    def create(self, tables: Iterable[str] = TABLES) -> ParquetStore:
        """Set up the folders; tables without batches are empty tables anyway."""
        files = Files(self.spark)
        for folder in ("_commits", *tables):
            files.make_folder(f"{self.root}/{folder}")
        return self

    def _texts(self, paths: list[str]) -> list[str]:
        """Entries of the log: one small text per batch since the last compaction."""
        return [row["value"] for row in self.spark.read.text(paths, wholetext=True).collect()]

    @contextmanager
    def batch(self, source: str, batch_id: int) -> Iterator[Batch]:
        """A batch over several tables; an exception leaves nothing of it behind that anyone reads."""
        writing = Batch(self, source, batch_id)
        yield writing
        writing.commit()

    def finished(self, source: str, batch_id: int) -> bool:
        """Has the batch been written, whatever tables it has?"""
        return self.log.has(source, batch_id)

    def mark(self, source: str, batch_id: int) -> None:
        """Note a batch as finished that writes no table."""
        self.log.commit(source, batch_id, [])

    def append(self, df: DataFrame, table: str, source: str, batch_id: int) -> None:
        with self.batch(source, batch_id) as writing:
            writing.append(df, table)

    def read(self, table: str, before_batch: int | None = None) -> DataFrame:
        """The table; ``before_batch`` leaves out that batch and later ones."""
        return self.batches(table, before_batch).drop("source", "batch_id")

    def batches(self, table: str, before_batch: int | None = None) -> DataFrame:
        """The table with the ``source`` and ``batch_id`` each row came with."""
        parts = self.parts(table)
        if before_batch is None:
            return self.rows_of(parts, table)
        rows = self.rows_of([p for p in parts if p.batch_id < before_batch], table)
        return rows.where(F.col("batch_id") < before_batch)

    def parts(self, table: str) -> list[Part]:
        """What finished batches hold of the table.  Reads the log, no data."""
        return [p for p in self.log.parts() if p.table == table]

    def rows_of(self, parts: list[Part], table: str) -> DataFrame:
        """The rows of some batches."""
        schema = T.StructType([*TABLES[table].fields, *_BATCH])
        if table in LAYOUT:
            # Each attempt is the root of its own folders.
            read = self.spark.read.schema(TABLES[table])
            found = [
                read.parquet(f"{self.root}/{p.path}")
                .withColumn("source", F.lit(p.source))
                .withColumn("batch_id", F.lit(p.batch_id).cast("long"))
                for p in parts
                if p.rows
            ]
            return reduce(DataFrame.unionByName, found) if found else empty(self.spark, schema)
        paths = [f"{self.root}/{p.path}" for p in parts]
        if not paths:
            return empty(self.spark, schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(*paths)

    def snapshot_parts(self, table: str, snapshot_id: int) -> list[Part]:
        return [p for p in self.parts(table) if (p.source, p.batch_id) == (SNAPSHOTS, snapshot_id)]

    def last_snapshot(self, before: int | None = None) -> tuple[int | None, dict[str, int]]:
        """Number of the newest stock snapshot, and the last batch it covers per stream."""
        marks = [p for p in self.parts("snapshot_marks") if before is None or p.batch_id < before]
        if not marks:
            return None, {}
        newest = max(marks, key=lambda p: p.batch_id)
        rows = self.rows_of([newest], "snapshot_marks").collect()
        return newest.batch_id, {r["stream"]: r["last_batch"] for r in rows}

    def laid_out(self) -> dict[str, int]:
        """Last batch per stream whose facts lie in folders by day."""
        rows = self.rows_of(self.parts("layout_marks"), "layout_marks")
        marks = rows.groupBy("stream").agg(F.max("last_batch").alias("last_batch")).collect()
        return {r["stream"]: r["last_batch"] for r in marks}

    def newest_batches(self, table: str) -> dict[str, int]:
        """Newest batch per stream that has written to the table, from the log alone."""
        newest: dict[str, int] = {}
        for p in self.parts(table):
            newest[p.source] = max(p.batch_id, newest.get(p.source, p.batch_id))
        return newest

    def compact_into(self, other: ParquetStore, tables: Iterable[str] = TABLES) -> None:
        """Copy the tables into another root, the batches of a stream put together.

        Run it while no stream writes, then restart the streams on the new root with
        their old checkpoints; the newest batch of each may then run again.  Batches the newest stock snapshot covers stay apart
        from later ones, and snapshots from each other.  Each stretch of batches becomes one batch of the
        new root, for all tables at once.
        """
        _, covered = self.last_snapshot()
        covered |= self.laid_out()
        for stream, newest in self.newest_batches("reservations").items():
            covered[stream] = newest_total(self.parts("reservation_totals"), stream, newest)
        wanted = set(tables)
        by_stream: dict[str, list[Part]] = {}
        for part in self.log.parts():
            by_stream.setdefault(part.source, []).append(part)
        stretches = []
        for stream, parts in by_stream.items():
            ids = sorted({p.batch_id for p in parts})
            if stream == SNAPSHOTS:
                spans = [(i, i) for i in ids]
            elif stream.startswith(TOTALS):
                # One sum is enough, and it must not reach into the batches that are put together after it.
                spans = [(i, i) for i in ids if i == covered.get(stream.removeprefix(TOTALS))]
            else:
                # The newest batch of a stream may be replayed and stays a batch of its own.
                done = ids[-1] - 1
                mark = min(covered.get(stream, -1), done)
                spans = [(0, mark), (mark + 1, done), (ids[-1], ids[-1])]
            for first, last in spans:
                inside = [p for p in parts if first <= p.batch_id <= last and p.table in wanted]
                if inside:
                    stretches.append((stream, last, inside))

        def copy(stream: str, last: int, inside: list[Part]) -> None:
            with other.batch(stream, last) as writing:
                for table in sorted({p.table for p in inside}):
                    rows = self.rows_of([p for p in inside if p.table == table], table)
                    writing.append(rows.drop(*[f.name for f in _BATCH]), table)

        run_together(self.spark, COPIES, *[(copy, *stretch) for stretch in stretches])

    def leftovers(self) -> list[str]:
        """Folders of attempts that no finished batch names: what failed or replaced attempts wrote.

        Some may be in writing, so remove them only while no stream runs; see :meth:`remove_leftovers`.
        """
        named = {f"{self.root}/{p.path}".rstrip("/").split("/")[-1] for p in self.log.parts()}
        found = Files(self.spark).listed(f"{self.root}/*/source=*/batch_id=*/a-*", folders=True)
        return [f.path for f in found if f.name not in named]

    def remove_leftovers(self) -> int:
        """Delete what :meth:`leftovers` lists, and say how many folders.  Run it while no stream writes."""
        files, found = Files(self.spark), self.leftovers()
        for path in found:
            files.remove_folder(path)
        return len(found)


def run_together(spark: SparkSession, at_once: int, *calls: tuple) -> None:
    """Run (function, arguments...) as concurrent jobs and raise what the first failing one raised."""
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max(1, min(at_once, len(calls)))) as pool:
        for done in [pool.submit(inherit(call), *args) for call, *args in calls]:
            done.result()


class JdbcBatch:
    """One micro-batch on its way into a database: each table is first written beside its target."""

    def __init__(self, store: JdbcStore, source: str, batch_id: int, skip: bool):
        self.store, self.source, self.batch_id, self.skip = store, source, batch_id, skip
        self._columns: dict[str, list[str]] = {}
        self._lock = Lock()

    def stage(self, table: str) -> str:
        """Tables of their own per stream, as streams write at the same time."""
        return f"stage_{self.source}_{table}"

    def append(self, df: DataFrame, table: str) -> None:
        if self.skip:
            return
        columns = self.store.columns(table)
        self.store.write(df.select(*columns), self.stage(table), "overwrite")
        with self._lock:
            self._columns[table] = columns

    def statements(self) -> list[str]:
        """What moves the rows and logs the batch, to be run in one transaction."""
        moves = [
            f"INSERT INTO {table} ({', '.join(columns)}) SELECT {', '.join(columns)} FROM {self.stage(table)}"
            for table, columns in sorted(self._columns.items())
        ]
        return [
            *moves,
            f"INSERT INTO {JdbcStore.LOG} (table_name, source, batch_id) "
            f"VALUES ('{JdbcStore.WHOLE}', '{self.source}', {int(self.batch_id)})",
        ]


class JdbcStore:
    """Tables in a database reached over JDBC.

    The caller supplies URL and properties; the tables must exist, as must
    ``batch_log (table_name, source, batch_id)``.  A recorded batch is not written again.

    :meth:`batch` writes staging tables in parallel, then moves their rows and logs the batch in one transaction:
    exactly once, for all its tables.  :meth:`append` writes one table directly; its log row follows the data in a
    transaction of its own, so a failure in between repeats that batch: at least once.
    """

    LOG, WHOLE = "batch_log", "*"
    # Rows a connection fetches at a time in reads split here, unless the properties say otherwise.
    FETCH = "10000"

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        properties: dict[str, str],
        splits: dict[str, dict] | None = None,
        run: Callable[[list[str]], None] | None = None,
    ):
        """``splits`` gives per table the arguments that read it in parallel
        (``column``, ``lowerBound``, ``upperBound``, ``numPartitions``), or just (``column``,
        ``numPartitions``): bounds are then asked for.  ``run`` executes statements in one transaction (default: over
        a connection of the driver's)."""
        self.spark = spark
        self.url = url
        self.properties = properties
        self.splits = splits or {}
        self.run = run or self._in_one_transaction

    def read(self, table: str, before_batch: int | None = None) -> DataFrame:
        """The table.  Rows carry no batch, so ``before_batch`` has no effect."""
        return self._read(table, self.splits.get(table, {}))

    def query(self, sql: str, alias: str = "q", split: str | None = None, parts: int = 1) -> DataFrame:
        """Result of a query the database runs, read in ``parts`` stretches of the column ``split`` if given."""
        splits = {"column": split, "numPartitions": parts} if split else {}
        return self._read(f"({sql}) {alias}", splits)

    def bounds(self, table: str, column: str) -> tuple | None:
        """Smallest and largest value of a column; None if there is none."""
        ends = self.query(f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}", "ends").first()
        return None if ends is None or ends["low"] is None else (ends["low"], ends["high"])

    def _read(self, table: str, split: dict) -> DataFrame:
        properties = self.properties
        if split and "lowerBound" not in split:
            ends = self.bounds(table, split["column"])
            split = split | {"lowerBound": ends[0], "upperBound": ends[1]} if ends else {}
            properties = {"fetchsize": self.FETCH, **properties} if ends else properties
        return self.spark.read.jdbc(self.url, table, properties=properties, **split)

    def columns(self, table: str) -> list[str]:
        """Columns a batch supplies; the database numbers the others."""
        serial = SERIAL_COLUMNS.get(table, [])
        return [c for c in TABLES[table].fieldNames() if c not in serial]

    @contextmanager
    def batch(self, source: str, batch_id: int) -> Iterator[JdbcBatch]:
        """A batch over several tables, visible as a whole and once."""
        writing = JdbcBatch(self, source, batch_id, skip=self.finished(source, batch_id))
        yield writing
        if not writing.skip:
            self.run(writing.statements())

    def finished(self, source: str, batch_id: int) -> bool:
        return self._recorded(self.WHOLE, source, batch_id)

    def mark(self, source: str, batch_id: int) -> None:
        self.run(JdbcBatch(self, source, batch_id, skip=False).statements())

    def append(self, df: DataFrame, table: str, source: str, batch_id: int) -> None:
        if self._recorded(table, source, batch_id):
            return
        self.write(df.select(*self.columns(table)), table, "append")
        row = [(table, source, batch_id)]
        schema = "table_name string, source string, batch_id bigint"
        self.write(self.spark.createDataFrame(row, schema), self.LOG, "append")

    def _recorded(self, table: str, source: str, batch_id: int) -> bool:
        done = self.query(
            f"SELECT batch_id FROM {self.LOG} WHERE table_name = '{table}' "
            f"AND source = '{source}' AND batch_id = {int(batch_id)}"
        )
        return not done.isEmpty()

    def write(self, df: DataFrame, table: str, mode: str) -> None:
        df.write.jdbc(self.url, table, mode=mode, properties=self.properties)

    def _in_one_transaction(self, statements: list[str]) -> None:
        jvm = self.spark.sparkContext._jvm
        wanted = jvm.java.util.Properties()
        for name, value in self.properties.items():
            wanted.setProperty(name, value)
        connection = jvm.java.sql.DriverManager.getConnection(self.url, wanted)
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            for sql in statements:
                statement.executeUpdate(sql)
            connection.commit()
        finally:
            # Closing without commit takes everything back.
            connection.close()
