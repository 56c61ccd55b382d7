"""Projections, filters and lookups used as building blocks.

All of them are narrow (no shuffle) except the joins, where the small side
is a dimension the planner broadcasts by size.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import calendar as cal


def scan_active_vehicles(vehicles: DataFrame) -> DataFrame:
    """Ids and capacity of active vehicles."""
    return vehicles.where(F.col("status") == "active").select("vehicle_id", "capacity_kg")


def scan_active_drivers(drivers: DataFrame) -> DataFrame:
    """Ids of active drivers."""
    return drivers.where(F.col("status") == "active").select("driver_id")


def scan_routes_projection(routes: DataFrame) -> DataFrame:
    """Route id, distance and estimated duration under short names."""
    return routes.select(
        "route_id",
        F.col("distance_km").alias("distance"),
        F.col("estimated_duration_hours").alias("est_duration"),
    )


def trips_with_destination(trips: DataFrame, routes: DataFrame) -> DataFrame:
    """Trips with their time window, load and destination city."""
    return trips.select(
        "trip_id",
        F.col("departure_datetime").alias("departure"),
        F.col("arrival_datetime").alias("arrival"),
        F.col("total_weight_kg").alias("total_weight"),
        "route_id",
    ).join(routes.select("route_id", F.col("destination_city").alias("city")), "route_id").drop(
        "route_id"
    )


def filter_status(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.where(F.col(column) == value)


def filter_recent(
    df: DataFrame,
    column: str,
    as_of: _dt.date | str,
    days: int | None = None,
    months: int | None = None,
) -> DataFrame:
    """Rows whose ``column`` is on or after ``as_of`` minus a day or month span."""
    if (days is None) == (months is None):
        raise ValueError("give exactly one of days / months")
    since = cal.days_before(as_of, days) if days is not None else cal.months_before(as_of, months)
    return df.where(F.col(column) >= F.lit(since))


def drop_null_rows(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def filter_weight_range(df: DataFrame, column: str = "package_weight_kg") -> DataFrame:
    """Keep ``0 < weight < 10000``; null weights drop."""
    from parcelflow.functions.metrics import weight_in_range

    return df.where(weight_in_range(column))


def select_rename(df: DataFrame, mapping: dict[str, str] | None = None, upper: bool = False) -> DataFrame:
    """Project and rename columns; ``upper=True`` upper-cases every name."""
    if mapping is None:
        mapping = {c: c for c in df.columns}
    cols: list[Column] = [
        F.col(src).alias(dst.upper() if upper else dst) for src, dst in mapping.items()
    ]
    return df.select(*cols)


def filter_not_equal(df: DataFrame, column: str, value: str) -> DataFrame:
    """``column != value`` with SQL three-valued logic: NULL rows drop too."""
    return df.where(F.col(column) != value)


def constant_columns(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(v) for name, v in values.items()})


def join_anti_count(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One-row count of ``left`` rows without a ``right`` match on ``key``."""
    return left.select(key).join(right.select(key), key, "left_anti").agg(
        F.count(F.lit(1)).alias("violations")
    )
