"""Small files next to tables: a few driver calls on whatever file system a path names."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class File:
    path: str
    name: str
    size: int
    modified: int


class Files:
    """List, read, replace and move files through Hadoop's file systems."""

    def __init__(self, spark: SparkSession):
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self._hadoop.fs.Path(path)
        return where, where.getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        where, fs = self._at(path)
        return fs.exists(where)

    def make_folder(self, path: str) -> None:
        where, fs = self._at(path)
        fs.mkdirs(where)

    def listed(self, pattern: str, folders: bool = False) -> list[File]:
        """Files (or folders) that match a glob, by name; hidden ones are left out."""
        where, fs = self._at(pattern)
        found = fs.globStatus(where) or []
        return sorted(
            (
                File(s.getPath().toString(), s.getPath().getName(), s.getLen(), s.getModificationTime())
                for s in found
                if s.isDirectory() == folders and s.getPath().getName()[0] not in "._"
            ),
            key=lambda f: f.path,
        )

    def below(self, folder: str) -> list[File]:
        """All files below a folder, by path; none if it does not exist."""
        where, fs = self._at(folder)
        if not fs.exists(where):
            return []
        found, walk = [], fs.listFiles(where, True)
        while walk.hasNext():
            s = walk.next()
            if s.getPath().getName()[0] not in "._":
                found.append(File(s.getPath().toString(), s.getPath().getName(), s.getLen(), s.getModificationTime()))
        return sorted(found, key=lambda f: f.path)

    def plain(self, path: str) -> str:
        """A path without scheme and host."""
        return self._hadoop.fs.Path(path).toUri().getPath()

    def read(self, path: str) -> str:
        where, fs = self._at(path)
        stream = fs.open(where)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def replace(self, path: str, text: str) -> None:
        """Write a whole file under another name, then put it in place in one step."""
        where, fs = self._at(path)
        folder, _, name = path.rpartition("/")
        draft = self._hadoop.fs.Path(f"{folder}/.{name}-{uuid.uuid4().hex}")
        fs.mkdirs(where.getParent())
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self._hadoop.fs.FileContext.getFileContext(where.toUri(), self._conf)
        options = self._hadoop.fs.Options.Rename
        array = self._gateway_array(options, options.OVERWRITE)
        context.rename(draft.makeQualified(fs.getUri(), fs.getWorkingDirectory()), fs.makeQualified(where), array)

    def _gateway_array(self, kind, *values):
        from pyspark import SparkContext

        array = SparkContext._gateway.new_array(kind, len(values))
        for i, value in enumerate(values):
            array[i] = value
        return array

    def move(self, path: str, target: str, modified: int | None = None) -> None:
        """Rename a file; ``modified`` (milliseconds) sets its time where the file system keeps one."""
        where, fs = self._at(path)
        to = self._hadoop.fs.Path(target)
        fs.mkdirs(to.getParent())
        if not fs.rename(where, to):
            raise OSError(f"cannot move {path} to {target}")
        if modified is not None:
            fs.setTimes(to, modified, -1)

    def remove_folder(self, path: str) -> None:
        where, fs = self._at(path)
        fs.delete(where, True)
