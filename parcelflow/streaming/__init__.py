"""Streaming: the daily ETL as an incremental AvailableNow query."""

from parcelflow.streaming.daily_load import run_available_now

__all__ = ["run_available_now"]
