"""Sinks: the Parquet warehouse, staging folders and JSON reports."""

from parcelflow.sinks.warehouse import (
    Warehouse,
    append_batch_insert,
    json_report_sink,
    stage_overwrite,
)

__all__ = ["Warehouse", "append_batch_insert", "json_report_sink", "stage_overwrite"]
