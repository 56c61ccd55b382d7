"""Operational tables as catalog tables, co-bucketed on ``trip_id``.

Deliveries and trips meet on ``trip_id`` in most reports and in the ETL
extract. Stored with the same number of buckets on that key (and sorted by
it), the sort-merge join between them needs no shuffle on either side, and
the per-trip pre-aggregations of the reports run on the buckets as they
are. The small tables are stored plainly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelflow import schemas
from parcelflow.sources.tables import TABLE_NAMES, FleetTables

BUCKET_KEYS = {"deliveries": "trip_id", "trips": "trip_id"}


def write_fleet_catalog(
    spark: SparkSession, tables: FleetTables, database: str, buckets: int, mode: str = "overwrite"
) -> None:
    """Save the six tables in ``database``; deliveries and trips bucketed by trip.

    Each bucketed table is hash-partitioned on its key into ``buckets``
    tasks first (Spark's bucket hash), so every bucket is one file.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in TABLE_NAMES:
        df: DataFrame = schemas.conform(tables.table(name), schemas.OLTP[name])
        key = BUCKET_KEYS.get(name)
        if key:
            writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        else:
            writer = df.write
        writer.mode(mode).format("parquet").saveAsTable(f"{database}.{name}")


def fleet_tables_from_catalog(spark: SparkSession, database: str) -> FleetTables:
    return FleetTables({name: (lambda name=name: spark.table(f"{database}.{name}")) for name in TABLE_NAMES})
