"""ETL extract and transform: operational rows -> delivery metrics.

The transform keeps the reference's order of steps exactly (trap T12):
null drop, delivery minutes, delay, on-time flag, weight filter, trip hours,
zero-to-null, deliveries per trip *after* those filters, then the ratios.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import calendar as cal
from parcelflow.functions import metrics as m
from parcelflow.operators.keys import join_group_values, join_heavy_hitters

# Fixed value: the extract's 35 columns, in order.
EXTRACT_COLUMNS = [
    "delivery_id", "customer_name", "tracking_number", "package_weight_kg",
    "scheduled_datetime", "delivered_datetime", "recipient_signature", "delivery_status",
    "trip_id", "departure_datetime", "arrival_datetime", "fuel_consumed_liters",
    "vehicle_id", "driver_id", "route_id", "origin_city", "destination_city", "distance_km",
    "toll_cost", "first_name", "last_name", "acquisition_date", "hire_date", "license_plate",
    "vehicle_type", "capacity_kg", "fuel_type", "vehicle_status", "employee_code",
    "license_number", "license_expiry", "phone", "driver_status", "route_code",
    "estimated_duration_hours",
]

DERIVED_COLUMNS = [
    "delivery_time_minutes", "delay_minutes", "is_on_time", "trip_duration_hours",
    "deliveries_in_trip", "deliveries_per_hour", "fuel_efficiency_km_per_liter",
    "cost_per_delivery", "revenue_per_delivery", "has_signature", "full_name",
    "age_months", "experience_months",
]


def kept_by_transform() -> Column:
    """The transform's row filters, all on delivery columns."""
    return (
        F.col("delivered_datetime").isNotNull()
        & F.col("scheduled_datetime").isNotNull()
        & m.weight_in_range("package_weight_kg")
    )


def extract_daily(
    deliveries: DataFrame,
    trips: DataFrame,
    routes: DataFrame,
    vehicles: DataFrame,
    drivers: DataFrame,
    as_of: _dt.date | str,
    days: int = 90,
    with_trip_sizes: bool = False,
    hot_trips: Sequence[int] = (),
) -> DataFrame:
    """Denormalised deliveries of the last ``days`` days (35 columns).

    The date filter sits on the deliveries scan; trips join on ``trip_id``
    (the one big-to-big join, hash-partitioned on the key), routes and
    vehicles are inner lookups and drivers a left lookup, all small
    dimensions the planner broadcasts by size.

    ``with_trip_sizes=True`` adds ``deliveries_in_trip``, the transform's
    per-trip count, computed on the deliveries side before the big join:
    the transform only drops rows by delivery columns, and a trip's route
    and vehicle keep or drop all its rows together, so counting the
    deliveries that pass the transform's filters per trip gives the same
    number. The partial counts join trips on ``trip_id`` like the
    deliveries do, so no extra shuffle of the batch is needed (none at all
    when deliveries and trips are co-bucketed on ``trip_id``). Where trips
    come with ``deliveries_in_trip`` already, it is taken as it is. Deliveries
    of ``hot_trips`` are not shuffled (``join_heavy_hitters``).
    """
    since = cal.days_before(as_of, days)
    d = deliveries.where(F.col("delivered_datetime") >= F.lit(since)).select(
        "delivery_id", "customer_name", "tracking_number", "package_weight_kg",
        "scheduled_datetime", "delivered_datetime", "recipient_signature", "delivery_status",
        "trip_id",
    )
    t = trips.select(
        "trip_id", "departure_datetime", "arrival_datetime", "fuel_consumed_liters",
        "vehicle_id", "driver_id", "route_id", *(c for c in ("deliveries_in_trip",) if c in trips.columns),
    )
    r = routes.select(
        "route_id", "origin_city", "destination_city", "distance_km", "toll_cost", "route_code",
        "estimated_duration_hours",
    )
    v = vehicles.select(
        "vehicle_id", "acquisition_date", "license_plate", "vehicle_type", "capacity_kg",
        "fuel_type", F.col("status").alias("vehicle_status"),
    )
    dr = drivers.select(
        "driver_id", "first_name", "last_name", "hire_date", "employee_code", "license_number",
        "license_expiry", "phone", F.col("status").alias("driver_status"),
    )
    extra = ["deliveries_in_trip"] if with_trip_sizes or "deliveries_in_trip" in t.columns else []
    if extra and "deliveries_in_trip" not in t.columns:
        sizes = d.where(kept_by_transform()).groupBy("trip_id").agg(
            F.count(F.lit(1)).alias("deliveries_in_trip")
        )
        t = t.join(sizes, "trip_id", "left")
    return (
        join_heavy_hitters(d, t, "trip_id", list(hot_trips))
        .join(r, "route_id")
        .join(v, "vehicle_id")
        .join(dr, "driver_id", "left")
        .select(*EXTRACT_COLUMNS, *extra)
    )


def add_group_size(df: DataFrame, key: str, name: str) -> DataFrame:
    """Attach the number of rows sharing ``key`` to every row.

    Counted with an aggregate (partial on the map side) and joined back on
    the key and a salt, so a key with a third of all rows is spread over
    ``HOT_KEY_SALTS`` tasks; a window would sort that whole group in one.
    Rows with a null key get a null size. ``df`` is read twice, so give it
    a stored input (the pipeline stages the extract) rather than a join chain.
    """
    sizes = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return join_group_values(df, sizes, key)


def transform_all(extracted: DataFrame, as_of: _dt.date | str) -> DataFrame:
    """Derive the delivery metrics of the fact table from the extract.

    Uses ``deliveries_in_trip`` when the extract already carries it
    (``extract_daily(..., with_trip_sizes=True)``), else counts it here.
    """
    df = extracted.dropna(subset=["delivered_datetime", "scheduled_datetime"])
    minutes = m.round_even(cal.minutes_between("scheduled_datetime", "delivered_datetime"), 2)
    df = df.withColumn("delivery_time_minutes", minutes.cast("decimal(12,2)"))
    df = df.withColumn(
        "delay_minutes", m.round_even(m.clip_lower_zero("delivery_time_minutes"), 2).cast("decimal(12,2)")
    )
    df = df.withColumn("is_on_time", m.is_on_time("delay_minutes"))
    df = df.where(m.weight_in_range("package_weight_kg"))
    hours = m.round_even(cal.hours_between("departure_datetime", "arrival_datetime"), 2).cast("decimal(10,2)")
    df = df.withColumn("trip_duration_hours", m.zero_to_null(hours))
    df = df.withColumn("fuel_consumed_liters", m.zero_to_null("fuel_consumed_liters"))
    if "deliveries_in_trip" not in df.columns:  # not precomputed by the extract
        df = add_group_size(df, "trip_id", "deliveries_in_trip")
    ref = cal.as_date(as_of)
    df = df.withColumns(
        {
            "deliveries_per_hour": m.deliveries_per_hour("deliveries_in_trip", "trip_duration_hours").cast(
                "decimal(10,2)"
            ),
            "fuel_efficiency_km_per_liter": m.fuel_efficiency("distance_km", "fuel_consumed_liters").cast(
                "decimal(10,2)"
            ),
            "cost_per_delivery": m.cost_per_delivery(
                "fuel_consumed_liters", "toll_cost", "deliveries_in_trip"
            ).cast("decimal(10,2)"),
            "revenue_per_delivery": m.revenue_per_delivery("package_weight_kg").cast("decimal(10,2)"),
            "has_signature": m.has_signature("recipient_signature"),
            "full_name": m.full_name("first_name", "last_name"),
            "age_months": cal.months_by_calendar(ref, "acquisition_date"),
            "experience_months": cal.months_by_calendar(ref, "hire_date"),
        }
    )
    return df.select(*EXTRACT_COLUMNS, *DERIVED_COLUMNS)
