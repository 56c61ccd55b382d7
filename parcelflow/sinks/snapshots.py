"""The list of a warehouse's live folders, as numbered manifests on shared storage.

A manifest says which folders make up every table. Data folders are written
first and never changed; a new manifest makes them visible at once. Readers of
an older manifest keep reading its folders. Two writers that started from the
same manifest cannot both commit: the number of the next one is taken once.
"""

from __future__ import annotations

import json
import posixpath

from pyspark.sql import SparkSession

# A live folder: the version it was written under and its partition folder ("" for tables without partitions).
Segment = tuple[str, str]


class CommitConflict(RuntimeError):
    """Another writer committed since this one read the warehouse."""


class Files:
    """The few file operations that Spark has no writer for, on any Hadoop file system."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def system(self, path: str):
        return self.path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return bool(self.system(path).exists(self.path(path)))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self.system(path).listStatus(self.path(path)))

    def delete(self, path: str) -> None:
        self.system(path).delete(self.path(path), True)

    def read_text(self, path: str) -> str:
        stream = self.system(path).open(self.path(path))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def put_new(self, path: str, text: str, scratch: str) -> bool:
        """Write a file whole under a name that nobody has yet; False where somebody has."""
        if self.exists(path):
            return False
        stream = self.system(scratch).create(self.path(scratch), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        fs = self._jvm.org.apache.hadoop.fs
        options = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        context = fs.FileContext.getFileContext(self.system(path).getUri(), self._conf)
        try:
            context.rename(self.path(scratch), self.path(path), options)
        except Exception:  # taken in the meantime, or the file system is in trouble
            if self.exists(path):
                return False
            raise
        return True


class Manifests:
    """Numbered manifests under ``root``; number 0 is a warehouse without tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.files = Files(spark)
        self.folder = posixpath.join(root, "_manifests")

    def _path(self, number: int) -> str:
        return posixpath.join(self.folder, f"{number:010d}.json")

    def numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self.files.names(self.folder) if n.endswith(".json") and n[:-5].isdigit()]

    def newest(self) -> int:
        return max(self.numbers(), default=0)

    def tables(self, number: int) -> dict[str, list[Segment]]:
        if number == 0:
            return {}
        found = json.loads(self.files.read_text(self._path(number)))["tables"]
        return {name: [tuple(s) for s in segments] for name, segments in found.items()}

    def settings(self, number: int) -> dict:
        """What was fixed when the warehouse was made."""
        return json.loads(self.files.read_text(self._path(number)))["settings"] if number else {}

    def commit(self, after: int, tables: dict[str, list[Segment]], settings: dict, token: str) -> int:
        """Make ``tables`` the warehouse's state, if ``after`` is still the newest manifest."""
        text = json.dumps({"snapshot": after + 1, "settings": settings, "tables": tables})
        if self.newest() != after or not self.files.put_new(self._path(after + 1), text, f"{self.folder}/.{token}"):
            raise CommitConflict(f"snapshot {after + 1} was committed by another writer")
        return after + 1

    def forget(self, number: int) -> None:
        self.files.delete(self._path(number))
