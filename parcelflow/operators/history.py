"""Versions of entities over time: close the old, open the new, look up the one valid at a date.

The second kind of slowly changing dimension, beside the insert-only loads of
``operators.dimensions``. A version holds from ``valid_from`` to ``valid_to``,
both included, and versions of an entity follow each other without gaps.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelflow import schemas
from parcelflow.functions import calendar as cal
from parcelflow.operators.keys import dedupe_keep_first

INTERVAL = ["version", "valid_from", "valid_to", "is_current"]


def close_out(history: DataFrame, now: DataFrame, key: str, as_of: _dt.date | str, schema: StructType) -> DataFrame:
    """The history after seeing the entities as they are ``as_of``.

    An entity whose attributes differ from its current version gets a new one
    from that day; the old one ends the day before, or goes where it began the
    same day. New entities get version 1; entities that are not in ``now``, and
    versions of a later day, stay as they are. Seeing the same entities again
    changes nothing. Of an entity that ``now`` holds twice, the row that sorts
    first counts; a null key is left out.
    """
    day = cal.as_date(as_of)
    attributes = [f.name for f in schema.fields if f.name != key and f.name not in INTERVAL]
    own = schemas.conform(now, schema).select(key, *attributes).where(F.col(key).isNotNull())
    seen = dedupe_keep_first(own.distinct(), [key], attributes)
    seen = seen.select(key, F.struct(*attributes).alias("_now"))
    open_ = history.where("is_current").select(
        key, F.struct(*attributes).alias("_was"), F.col("version").alias("_version"), F.col("valid_from").alias("_from")
    )
    both = seen.join(open_, key, "left")
    differs = ~F.col("_now").eqNullSafe(F.col("_was"))
    due = F.col("_from").isNull() | (F.col("_from") <= F.lit(day))
    same_day = F.coalesce(F.col("_from") == F.lit(day), F.lit(False))
    version = F.coalesce("_version", F.lit(0)) + F.when(same_day, 0).otherwise(1)
    opened = both.where(differs & due).select(
        key, version.alias("version"), "_now.*", F.lit(day).alias("valid_from"), F.lit(cal.OPEN_END_DATE).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    ending = opened.select(key, F.lit(True).alias("_ends"))
    old = history.join(ending, key, "left").withColumn("_ends", F.coalesce("_ends", F.lit(False)) & F.col("is_current"))
    kept = old.where(~(F.col("_ends") & (F.col("valid_from") == F.lit(day)))).withColumns({
        "valid_to": F.when(F.col("_ends"), F.lit(day - _dt.timedelta(days=1))).otherwise(F.col("valid_to")),
        "is_current": F.col("is_current") & ~F.col("_ends"),
    })
    return schemas.conform(kept.drop("_ends").unionByName(opened), schema)


def valid_at(rows: DataFrame, history: DataFrame, key: str, date: str, columns: list[str]) -> DataFrame:
    """``rows`` with ``columns`` of the version of their entity valid at ``date`` (a column).

    An equi-join on the entity with the interval as a further condition, so a
    row meets the few versions of its own entity only. Before the first version
    the first one holds. Rows without an entity or a date are left out.
    """
    versions = history.select(
        key, (F.col("version") == 1).alias("_first"), F.col("valid_from").alias("_start"), F.col("valid_to").alias("_end"),
        *columns,
    )
    day = F.col(date).cast("date")
    holds = (day <= F.col("_end")) & (F.col("_first") | (day >= F.col("_start")))
    return rows.join(versions, key).where(holds).drop("_first", "_start", "_end")
