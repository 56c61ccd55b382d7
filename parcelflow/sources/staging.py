"""Landing table for raw semi-structured rows (VARIANT + load time)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import calendar as cal


def stage_raw_json(df: DataFrame, load_ts: _dt.datetime | None = None) -> DataFrame:
    """Each row of ``df`` as one VARIANT value plus its load timestamp.

    ``load_ts`` defaults to the session's local time at execution, like a
    column DEFAULT of the current timestamp.
    """
    raw = F.parse_json(F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    stamp = cal.ntz_literal(load_ts) if load_ts is not None else F.localtimestamp()
    return df.select(raw.alias("raw_data"), stamp.alias("load_timestamp"))


def raw_field(path: str, dtype: str, column: str = "raw_data") -> Column:
    """Typed field of a staged VARIANT, e.g. ``raw_field('$.delivery_id', 'bigint')``."""
    return F.variant_get(F.col(column), path, dtype)
