"""Re-aimed table operations: spread dates, time slots, proportional shares.

In the reference these steps live inside the random data generator; here
they are deterministic DataFrame operators over real tables. Row expansion
is ``explode(sequence(...))`` in chunks spread over tasks (``explode_range``);
group totals come from an aggregate joined back on the group key, never
from a window over a possibly huge group.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import calendar as cal
from parcelflow.functions import metrics as m
from parcelflow.operators.keys import join_group_values

# Most rows one task expands in one go; bigger counts are split into chunks
# that are spread over tasks before the expansion.
EXPLODE_CHUNK = 100_000
TRIPS_PER_SERVICE = 20
# Fixed value: days from one service to the next.
SERVICE_INTERVAL_DAYS = 90
DEFAULT_SLOT_HOURS = 0.5
ALLOCATED_SHARE = "0.95"
MIN_SHARE = "0.5"


def explode_range(df: DataFrame, count_col: str, out_col: str, first: int = 1, chunk: int = EXPLODE_CHUNK) -> DataFrame:
    """One row per value ``first .. first + count - 1`` of each input row.

    Rows are first expanded into chunk descriptors (one per ``chunk``
    values) and redistributed on (row, chunk), then each chunk is expanded.
    A row whose count is a third of all output is thus produced by many
    tasks, not one. Rows with a count below 1 (or NULL) produce nothing.
    """
    n = F.col(count_col).cast("bigint")
    chunks = df.where(n >= 1).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / chunk).cast("bigint")))
    )
    spread = chunks.repartition(F.xxhash64(*[F.col(c) for c in df.columns], F.col("_chunk")))
    lo = F.lit(first) + F.col("_chunk") * chunk
    hi = F.least(F.lit(first) + n - 1, lo + chunk - 1)
    return spread.withColumn(out_col, F.explode(F.sequence(lo, hi))).drop("_chunk")


def spread_dates(activity: DataFrame, trips_per_item: int = TRIPS_PER_SERVICE) -> DataFrame:
    """Evenly spaced dates inside each vehicle's active span.

    For a vehicle with ``trip_count`` trips between ``first_trip`` and
    ``last_trip``: n = max(1, trip_count div 20) dates, the i-th (1-based)
    at ``first_trip + floor(days * i / (n + 1))`` days, where ``days`` is the
    whole-day span. First = earliest, last = latest departure (trap T16).
    """
    n = F.greatest(F.lit(1), F.floor(F.col("trip_count") / trips_per_item).cast("int"))
    days = F.floor(F.timestamp_diff("SECOND", F.col("first_trip"), F.col("last_trip")) / 86400).cast("bigint")
    base = activity.select("vehicle_id", "vehicle_type", "first_trip", n.alias("_n"), days.alias("_days"))
    return (
        explode_range(base, "_n", "seq")
        .select(
            "vehicle_id",
            "vehicle_type",
            F.col("seq").cast("int").alias("seq"),
            F.date_add(
                F.to_date("first_trip"), F.floor(F.col("_days") * F.col("seq") / (F.col("_n") + 1)).cast("int")
            ).alias("scheduled_date"),
        )
        .withColumn("next_service_date", F.date_add("scheduled_date", SERVICE_INTERVAL_DAYS))
    )


def slot_times(trips: DataFrame, slots: DataFrame, default_slot_hours: float = DEFAULT_SLOT_HOURS) -> DataFrame:
    """Time of slot i of n inside each trip: departure + (i + 0.5) x duration / n.

    ``slots`` holds (trip_id, n). Without an arrival every slot lasts
    ``default_slot_hours``. Slots count from 0; offsets are whole
    microseconds (floor).
    """
    dur_us = cal.micros_between("departure_datetime", "arrival_datetime")
    slot_us = int(default_slot_hours * 3_600_000_000)
    joined = trips.select("trip_id", "departure_datetime", "arrival_datetime").join(slots, "trip_id")
    spans = joined.select(
        "trip_id", "departure_datetime", "n", F.coalesce(dur_us, F.col("n") * slot_us).alias("_span")
    )
    expanded = explode_range(spans, "n", "slot", first=0)
    offset = F.expr("((2 * slot + 1) * _span) div (2 * n)")
    return expanded.select(
        "trip_id",
        F.col("slot").cast("int").alias("slot"),
        "n",
        F.timestamp_add("MICROSECOND", offset, F.col("departure_datetime")).alias("slot_datetime"),
    )


def proportional_allocation(
    df: DataFrame,
    group_col: str,
    weight_col: str,
    total_col: str,
    out_col: str = "allocated",
    share: str = ALLOCATED_SHARE,
    floor_value: str = MIN_SHARE,
) -> DataFrame:
    """Split each group's ``total_col`` in proportion to ``weight_col``.

    allocated = max(weight / sum(weight of group) x total x share, floor),
    rounded half-even to 2 places. The group sum is an aggregate joined back
    on ``group_col`` and a salt, so one huge group does not sit in one task.
    """
    sums = df.groupBy(group_col).agg(F.sum(weight_col).alias("_wsum"))
    raw = F.col(weight_col) * F.col(total_col) * F.lit(share).cast("decimal(3,2)") / F.nullif(
        F.col("_wsum"), F.lit(0)
    )
    alloc = F.greatest(m.round_even(raw, 2), F.lit(floor_value).cast("decimal(3,1)"))
    return join_group_values(df, sums, group_col).withColumn(out_col, alloc.cast("decimal(12,2)")).drop("_wsum")


def trip_status_as_of(trips: DataFrame, as_of: _dt.date | str) -> DataFrame:
    """Status relative to ``as_of``: completed when the arrival lies before it.

    The arrival is kept only for completed trips.
    """
    cutoff = F.lit(cal.as_date(as_of)).cast("timestamp_ntz")
    status = m.trip_status("arrival_datetime", cutoff)
    return trips.select(
        "trip_id",
        "departure_datetime",
        F.when(status == "completed", F.col("arrival_datetime")).alias("arrival_datetime"),
        status.alias("status"),
    )
