"""Command-line jobs (``python -m parcelflow`` or ``spark-submit``).

    python -m parcelflow reports --source parquet:/shared/fleet --as-of 2026-12-01 --out /shared/reports
    python -m parcelflow etl --source catalog:fleet --warehouse /shared/warehouse --as-of 2026-12-01

``--source`` is ``parquet:<folder>``, ``catalog:<database>`` or ``testdata:<sf folder>``.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from dataclasses import asdict

from pyspark.sql import SparkSession

from parcelflow.operators import quality, reports
from parcelflow.plans.pipeline import run_pipeline
from parcelflow.session import build_session
from parcelflow.sinks.warehouse import Warehouse, json_report_sink
from parcelflow.sources import fleet_tables_from_catalog, fleet_tables_from_parquet
from parcelflow.sources.driver_tables import fleet_tables_from_driver_data
from parcelflow.sources.tables import FleetTables


def open_source(spark: SparkSession, source: str) -> FleetTables:
    kind, _, where = source.partition(":")
    if kind == "parquet":
        return fleet_tables_from_parquet(spark, where)
    if kind == "catalog":
        return fleet_tables_from_catalog(spark, where)
    if kind == "testdata":
        return fleet_tables_from_driver_data(spark, where)
    raise ValueError(f"unknown source {source!r}: use parquet:, catalog: or testdata:")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="parcelflow")
    sub = parser.add_subparsers(dest="command", required=True)
    rep = sub.add_parser("reports", help="write the twelve reports and the quality report")
    rep.add_argument("--source", required=True)
    rep.add_argument("--as-of", required=True)
    rep.add_argument("--out", required=True)
    rep.add_argument("--lang", default="en")
    etl = sub.add_parser("etl", help="run one ETL batch into a warehouse")
    etl.add_argument("--source", required=True)
    etl.add_argument("--warehouse", required=True)
    etl.add_argument("--as-of", required=True)
    etl.add_argument("--batch-id", type=int, default=None)
    args = parser.parse_args(argv)

    spark = spark or build_session("parcelflow-" + args.command)
    tables = open_source(spark, args.source)
    if args.command == "reports":
        for name, df in reports.all_reports(tables, args.as_of, args.lang).items():
            df.write.mode("overwrite").parquet(os.path.join(args.out, name))
        json_report_sink(quality.dq_report(tables), os.path.join(args.out, "data_quality"))
    else:
        metrics = run_pipeline(spark, tables, Warehouse(spark, args.warehouse), args.as_of, batch_id=args.batch_id)
        print(json.dumps(asdict(metrics), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
