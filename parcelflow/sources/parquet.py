"""Parquet scans of the operational tables with explicit schemas."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from parcelflow import schemas
from parcelflow.sources.tables import TABLE_NAMES, FleetTables


def scan_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Full scan of one operational table (all columns, declared types).

    Catalyst prunes columns and pushes filters of the caller into this scan.
    """
    return spark.read.schema(schemas.OLTP[name]).parquet(path)


def fleet_tables_from_parquet(spark: SparkSession, root: str) -> FleetTables:
    """The six tables stored as ``<root>/<table>`` Parquet folders."""
    return FleetTables(
        {
            name: (lambda name=name: scan_table(spark, os.path.join(root, name), name))
            for name in TABLE_NAMES
        }
    )


def write_fleet_tables(
    tables: FleetTables, root: str, mode: str = "overwrite", files_per_table: int | None = None
) -> None:
    """Persist a table set as Parquet folders (one job per table).

    ``files_per_table`` spreads each table over that many files, so later
    scans run in parallel even when a source arrived as one file.
    """
    for name in TABLE_NAMES:
        df = schemas.conform(tables.table(name), schemas.OLTP[name])
        if files_per_table:
            df = df.repartition(files_per_table)
        df.write.mode(mode).parquet(os.path.join(root, name))
