"""Small JSON files beside the data, on whatever file system the data is on: versions of a table, marks, the state of a job.

A version appears whole or not at all: its text is written under another name and renamed, and renaming fails if another
writer was first.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class SharedFiles:
    """The few operations on files that a driver needs, through Spark's own file-system layer."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def _system(self, path: str):
        return self._path(path).getFileSystem(self.conf)

    def exists(self, path: str) -> bool:
        return self._system(path).exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        """The names in a folder, none if it does not exist."""
        if not self.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._system(folder).listStatus(self._path(folder)))

    def sizes(self, path: str) -> list[tuple[str, int, int]]:
        """``(path, bytes, time of change)`` of all files below, data files only."""
        found, folders = [], [path]
        while folders:
            for status in self._system(path).globStatus(self._path(folders.pop())) or []:
                name = status.getPath().getName()
                if name.startswith(("_", ".")):
                    continue
                if status.isDirectory():
                    folders.append(f"{status.getPath().toString()}/*")
                else:
                    found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
        return sorted(found)

    def read(self, path: str) -> str:
        stream = self._system(path).open(self._path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> bool:
        """Write a file that must not exist yet; false if it does, whoever wrote it."""
        folder, _, name = path.rpartition("/")
        draft = f"{folder}/.{name}.{self.jvm.java.util.UUID.randomUUID().toString()}"
        stream = self._system(path).create(self._path(draft), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        files = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(draft).toUri(), self.conf)
        kind = getattr(self.jvm, "org.apache.hadoop.fs.Options$Rename")
        try:
            files.rename(self._path(draft), self._path(path), self.gateway.new_array(kind, 0))
        except Exception:
            self.delete(draft)
            if self.exists(path):
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        self._system(path).delete(self._path(path), True)


def newest(files: SharedFiles, folder: str, below: int | None = None) -> tuple[int, dict] | None:
    """The number and content of the newest version in a folder, of those ``below`` a number if one is given."""
    numbers = [int(name.removesuffix(".json")) for name in files.names(folder) if name.endswith(".json") and name[0] != "."]
    numbers = [n for n in numbers if below is None or n < below]
    if not numbers:
        return None
    return max(numbers), json.loads(files.read(f"{folder}/{max(numbers):012d}.json"))


def add_version(files: SharedFiles, folder: str, number: int, content: dict) -> bool:
    """Make ``content`` version ``number``; false if that version exists."""
    return files.write_new(f"{folder}/{number:012d}.json", json.dumps(content, sort_keys=True))
