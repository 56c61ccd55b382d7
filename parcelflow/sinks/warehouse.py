"""Path-based Parquet warehouse and the writers the ETL uses.

The warehouse lies under one root, which on a cluster is shared storage (the
same kind of folder as ``spark.checkpoint.dir``). Every write goes to a new
folder ``<table>/written=<v>/`` through Spark's commit protocol, so a lost
executor only reruns its task, and becomes visible with the manifest that
names it (``sinks.snapshots``). A batch wraps its writes in ``transaction()``:
it sees its own writes, everybody else sees all of them at once or, when the
batch fails, none.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parcelflow import schemas
from parcelflow.sinks.snapshots import Files, Manifests, Segment


class Warehouse:
    """The star-schema tables under ``root``.

    ``state_buckets``: hash buckets of the load state, chosen when the warehouse
    is made and kept from then on. A bucket should hold some ten million
    deliveries at most.
    """

    def __init__(self, spark: SparkSession, root: str, state_buckets: int = 16):
        self.spark = spark
        self.root = root.rstrip("/")
        self.manifests = Manifests(spark, self.root)
        made = self.manifests.settings(self.manifests.newest())
        self.state_buckets = int(made.get("state_buckets", state_buckets))
        self._open: dict[str, list[Segment]] | None = None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stage_path(self, batch_id: int) -> str:
        return f"{self.root}/_stage/etl_batch_id={int(batch_id)}"

    def snapshot(self) -> int:
        """Number of the newest commit."""
        return self.manifests.newest()

    def segments(self, name: str, snapshot: int | None = None) -> list[Segment]:
        """The folders that make up a table: in a transaction as it sees them, else as of a commit (the newest)."""
        if snapshot is None and self._open is not None:
            return list(self._open.get(name, []))
        return self.manifests.tables(self.snapshot() if snapshot is None else snapshot).get(name, [])

    def exists(self, name: str) -> bool:
        return bool(self.segments(name))

    def read(self, name: str, snapshot: int | None = None) -> DataFrame:
        """The table with its declared schema; empty when it was never written."""
        schema = schemas.WAREHOUSE[name]
        folders = [f"{self.path(name)}/written={v}/{part}".rstrip("/") for v, part in self.segments(name, snapshot)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.path(name))
        return reader.parquet(*folders).select(*schema.names)

    @contextmanager
    def transaction(self) -> Iterator[int]:
        """Writes inside become visible together when the block ends well; yields the number they will have."""
        if self._open is not None:
            raise RuntimeError("a transaction is already open")
        before = self.snapshot()
        self._open = self.manifests.tables(before)
        try:
            yield before + 1
            tables = self._open
        finally:
            self._open = None
        self.manifests.commit(before, tables, {"state_buckets": self.state_buckets}, uuid.uuid4().hex)

    def _change(self, name: str, added: list[Segment], dropped: set[str] | None) -> None:
        """``dropped``: partition folders whose older versions go; None for all."""
        if self._open is None:
            with self.transaction():
                self._change(name, added, dropped)
            return
        kept = [] if dropped is None else [s for s in self._open.get(name, []) if s[1] not in dropped]
        self._open[name] = kept + added

    def _write(self, name: str, df: DataFrame, partition_by: list[str]) -> list[Segment]:
        """A new version's folders; none for an empty frame."""
        version = uuid.uuid4().hex
        folder = f"{self.path(name)}/written={version}"
        seen = Observation()
        rows = schemas.conform(df, schemas.WAREHOUSE[name]).observe(seen, F.count(F.lit(1)).alias("rows"))
        append_batch_insert(rows, folder, partition_by)
        if not seen.get.get("rows", 0):
            return []
        if not partition_by:
            return [(version, "")]
        parts, files = [""], Files(self.spark)
        for column in partition_by:
            parts = [
                f"{p}/{n}".lstrip("/") for p in parts for n in files.names(f"{folder}/{p}") if n.startswith(f"{column}=")
            ]
        return [(version, p) for p in parts]

    def append(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> None:
        added = self._write(name, df, partition_by or [])
        if added:
            self._change(name, added, set())

    def replace(self, name: str, df: DataFrame) -> None:
        """Put ``df`` in place of the whole table."""
        self._change(name, self._write(name, df, []), None)

    def replace_partitions(self, name: str, df: DataFrame, partition_by: list[str]) -> None:
        """Put ``df`` in place of the partitions it has rows of."""
        added = self._write(name, df, partition_by)
        self._change(name, added, {part for _, part in added})

    def drop_partitions(self, name: str, column: str, values: list) -> None:
        """Remove whole partitions: those that a rewrite left without rows."""
        if values:
            self._change(name, [], {f"{column}={v}" for v in values})

    def partition_values(self, name: str, column: str) -> set[str]:
        """Values of the first partition column that the table has folders of."""
        return {part.split("/")[0].removeprefix(f"{column}=") for _, part in self.segments(name)}

    def vacuum(self, keep: int = 10) -> int:
        """Drop all but the last ``keep`` commits and the folders that none of those needs.

        Only for times without a running batch: folders not committed yet go as well.
        """
        numbers = sorted(self.manifests.numbers())
        kept, gone = numbers[-keep:], numbers[:-keep]
        needed = {(t, v) for n in kept for t, segments in self.manifests.tables(n).items() for v, _ in segments}
        files, dropped = Files(self.spark), 0
        for name in schemas.WAREHOUSE:
            for folder in files.names(self.path(name)):
                if folder.startswith("written=") and (name, folder.removeprefix("written=")) not in needed:
                    files.delete(f"{self.path(name)}/{folder}")
                    dropped += 1
        for n in gone:
            self.manifests.forget(n)
        return dropped

    def drop_stage(self, batch_id: int) -> None:
        """Remove a finished batch's stage folder."""
        Files(self.spark).delete(self.stage_path(batch_id))


def append_batch_insert(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append rows to a Parquet table; every task writes its own files."""
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def stage_overwrite(df: DataFrame, path: str) -> DataFrame:
    """Replace a staging folder with ``df`` and return a reader of it.

    The returned frame's lineage starts at the written files, so later
    steps never recompute the stage, even after an executor is lost.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def json_report_sink(df: DataFrame, path: str) -> None:
    """Write a small report (one row per check, or one summary row) as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its file system (local, HDFS or object store)."""
    return Files(spark).exists(path)
