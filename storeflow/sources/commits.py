"""The log of finished batches.

One small JSON file per (stream, batch) names the folders of all tables the batch has written, and how many rows each
holds.  It is put in place in one step after everything else, so a batch is there for all tables or for none: what a
failed attempt left behind has no entry.  Writing a batch again replaces its entries.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

from storeflow.sources.files import File, Files

# More unread entries than this are read by a Spark job, not one after another.
READ_HERE = 200


@dataclass(frozen=True)
class Part:
    """What one batch holds of one table; ``path`` is relative to the store."""

    source: str
    batch_id: int
    table: str
    path: str
    rows: int


class CommitLog:
    """Entries below one folder: ``<source>/<batch>.json``."""

    def __init__(self, spark: SparkSession, folder: str, read_many: Callable[[list[str]], list[str]]):
        """``read_many`` gives the contents of many small files, in any order."""
        self.folder = folder
        self.read_many = read_many
        self.files = Files(spark)
        # Entries are written once per attempt, so name, size and time say whether one was read before.
        self._read: dict[File, list[Part]] = {}

    def parts(self) -> list[Part]:
        """Everything that finished batches have written."""
        listed = self.files.listed(f"{self.folder}/*/*.json")
        fresh = [f for f in listed if f not in self._read]
        texts = self._texts(fresh)
        for file in fresh:
            self._read[file] = [Part(**p) for p in json.loads(texts[file.path])["parts"]]
        self._read = {file: self._read[file] for file in listed}
        return [part for file in listed for part in self._read[file]]

    def _texts(self, files: list[File]) -> dict[str, str]:
        if len(files) <= READ_HERE:
            return {f.path: self.files.read(f.path) for f in files}
        # Entries hold their own place, as a reader may spell a path otherwise.
        by_key = {}
        for text in self.read_many([f.path for f in files]):
            entry = json.loads(text)
            by_key[(entry["source"], entry["batch_id"])] = text
        return {f.path: by_key[(f.path.split("/")[-2], int(f.name.split(".")[0]))] for f in files}

    def commit(self, source: str, batch_id: int, parts: list[Part]) -> None:
        """Make a batch visible, with these parts and no others."""
        entry = {"source": source, "batch_id": batch_id, "parts": [asdict(p) for p in parts]}
        self.files.replace(f"{self.folder}/{source}/{batch_id}.json", json.dumps(entry))

    def has(self, source: str, batch_id: int) -> bool:
        """Is the batch finished?"""
        return self.files.exists(f"{self.folder}/{source}/{batch_id}.json")

    def of(self, source: str, batch_id: int) -> list[Part]:
        return [p for p in self.parts() if (p.source, p.batch_id) == (source, batch_id)]
