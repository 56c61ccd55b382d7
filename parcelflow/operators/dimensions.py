"""Dimension builds: stage -> insert-if-absent -> key map.

The reference MERGEs each staged dimension with only a WHEN NOT MATCHED
branch; here that is a left-anti join of the staged rows against the
existing dimension, whose result is appended. Existing rows are never
updated (trap T9: insert-only, despite the SCD-2 column names).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow import schemas
from parcelflow.functions import calendar as cal
from parcelflow.operators.keys import assign_sequential_keys, dedupe_keep_first

# Defaults written on insert.
DRIVER_PERFORMANCE_DEFAULT = "Medio"
ROUTE_DIFFICULTY_DEFAULT = "Medio"
ROUTE_TYPE_DEFAULT = "Interurbana"
CUSTOMER_TYPE_DEFAULT = "Individual"
CUSTOMER_CATEGORY_DEFAULT = "Regular"

# Deterministic stand-in for "the first row" of a pandas drop_duplicates.
FIRST_ROW_ORDER = ["scheduled_datetime", "delivery_id"]


def merge_insert_if_absent(
    staged: DataFrame, existing: DataFrame, keys: Sequence[str], existing_filter: Column | None = None
) -> DataFrame:
    """Staged rows whose ``keys`` have no match in ``existing`` (optionally filtered)."""
    target = existing if existing_filter is None else existing.where(existing_filter)
    return staged.join(target.select(*keys), list(keys), "left_anti")


def _validity(as_of: _dt.date) -> dict[str, Column]:
    return {
        "valid_from": F.lit(as_of),
        "valid_to": F.lit(cal.OPEN_END_DATE),
        "is_current": F.lit(True),
    }


def _entities(rows: DataFrame, cols: list[str]) -> DataFrame:
    """One row per id, the first of ``cols``.

    The columns come from the id's entity row, so a hash ``distinct`` (partial
    on the map side) reduces deliveries to entities before anything is sorted.
    """
    return dedupe_keep_first(rows.select(*cols).distinct(), cols[:1], cols[1:]).select(*cols)


def stage_vehicles(transformed: DataFrame) -> DataFrame:
    cols = ["vehicle_id", "license_plate", "vehicle_type", "capacity_kg", "fuel_type",
            "acquisition_date", "age_months", "vehicle_status"]
    return _entities(transformed, cols)


def vehicle_inserts(staged: DataFrame, existing: DataFrame, as_of: _dt.date | str) -> DataFrame:
    """New ``dim_vehicle`` rows: key = vehicle id, valid from ``as_of``, current."""
    new = merge_insert_if_absent(staged, existing, ["vehicle_id"], F.col("is_current"))
    rows = new.withColumn("vehicle_key", F.col("vehicle_id")).withColumn(
        "status", F.col("vehicle_status")
    ).withColumns(_validity(cal.as_date(as_of)))
    return schemas.conform(rows, schemas.DIM_VEHICLE)


def stage_drivers(transformed: DataFrame) -> DataFrame:
    """Driver rows of the batch; a missing driver (left join) is not staged (T13)."""
    cols = ["driver_id", "employee_code", "full_name", "license_number", "license_expiry",
            "phone", "hire_date", "experience_months", "driver_status"]
    with_driver = transformed.where(F.col("driver_id").isNotNull() & F.col("employee_code").isNotNull())
    return _entities(with_driver, cols)


def driver_inserts(staged: DataFrame, existing: DataFrame, as_of: _dt.date | str) -> DataFrame:
    new = merge_insert_if_absent(staged, existing, ["driver_id"], F.col("is_current"))
    rows = (
        new.withColumn("driver_key", F.col("driver_id"))
        .withColumn("status", F.col("driver_status"))
        .withColumn("performance_category", F.lit(DRIVER_PERFORMANCE_DEFAULT))
        .withColumns(_validity(cal.as_date(as_of)))
    )
    return schemas.conform(rows, schemas.DIM_DRIVER)


def stage_routes(transformed: DataFrame) -> DataFrame:
    cols = ["route_id", "route_code", "origin_city", "destination_city", "distance_km",
            "estimated_duration_hours", "toll_cost"]
    return _entities(transformed, cols)


def route_inserts(staged: DataFrame, existing: DataFrame) -> DataFrame:
    new = merge_insert_if_absent(staged, existing, ["route_id"])
    rows = new.withColumns(
        {
            "route_key": F.col("route_id"),
            "difficulty_level": F.lit(ROUTE_DIFFICULTY_DEFAULT),
            "route_type": F.lit(ROUTE_TYPE_DEFAULT),
        }
    )
    return schemas.conform(rows, schemas.DIM_ROUTE)


def stage_customers(transformed: DataFrame) -> DataFrame:
    """One row per customer name; the city is the destination of its first delivery.

    A NULL name is not staged: it could never match the existing dimension,
    so it would be inserted again by every batch (and no fact row can use it).
    """
    return dedupe_keep_first(
        transformed.where(F.col("customer_name").isNotNull()).select(
            "customer_name", "destination_city", *FIRST_ROW_ORDER
        ),
        ["customer_name"],
        FIRST_ROW_ORDER,
    ).select("customer_name", "destination_city")


def customer_inserts(
    staged: DataFrame, existing: DataFrame, as_of: _dt.date | str, max_key: int | None = None
) -> DataFrame:
    """New ``dim_customer`` rows with keys continuing after the current maximum.

    New names are numbered in name order by :func:`assign_sequential_keys`;
    ``customer_id`` equals the key (trap T18). With ``max_key`` given,
    ``existing`` needs to hold the staged names only.
    """
    new = merge_insert_if_absent(staged, existing, ["customer_name"])
    if max_key is None:
        max_key = existing.agg(F.max("customer_key")).first()[0] or 0
    keyed = assign_sequential_keys(new, ["customer_name"], int(max_key) + 1, "customer_key")
    rows = keyed.withColumns(
        {
            "customer_id": F.col("customer_key"),
            "customer_type": F.lit(CUSTOMER_TYPE_DEFAULT),
            "city": F.col("destination_city"),
            "first_delivery_date": F.lit(cal.as_date(as_of)),
            "total_deliveries": F.lit(0),
            "customer_category": F.lit(CUSTOMER_CATEGORY_DEFAULT),
        }
    )
    return schemas.conform(rows, schemas.DIM_CUSTOMER)


def date_rows(transformed: DataFrame) -> DataFrame:
    """``dim_date`` attributes of each distinct scheduled date (T21)."""
    dates = transformed.select(F.to_date("scheduled_datetime").alias("full_date")).where(
        F.col("full_date").isNotNull()
    ).distinct()
    d = F.col("full_date")
    q = F.quarter(d)
    rows = dates.select(
        cal.date_key(d).alias("date_key"),
        d,
        cal.iso_weekday(d).alias("day_of_week"),
        cal.day_name(d).alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        cal.iso_week(d).alias("week_of_year"),
        F.month(d).alias("month_num"),
        cal.month_name(d).alias("month_name"),
        q.alias("quarter"),
        F.year(d).alias("year"),
        cal.is_weekend(d).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        F.lit(None).cast("string").alias("holiday_name"),
        q.alias("fiscal_quarter"),
        F.year(d).alias("fiscal_year"),
    )
    return schemas.conform(rows, schemas.DIM_DATE)


def date_inserts(transformed: DataFrame, existing: DataFrame) -> DataFrame:
    return merge_insert_if_absent(date_rows(transformed), existing, ["date_key"])


def time_rows(transformed: DataFrame) -> DataFrame:
    """``dim_time`` rows (hour grain) for every scheduled and delivered hour."""
    hours = (
        transformed.select(F.hour("scheduled_datetime").alias("hour"))
        .union(transformed.select(F.hour("delivered_datetime").alias("hour")))
        .where(F.col("hour").isNotNull())
        .distinct()
    )
    h = F.col("hour")
    rows = hours.select(
        (h * 100).alias("time_key"),
        h,
        F.lit(0).alias("minute"),
        F.lit(0).alias("second"),
        cal.time_of_day(h).alias("time_of_day"),
        cal.hour_24_label(h).alias("hour_24"),
        cal.hour_12_label(h).alias("hour_12"),
        cal.am_pm(h).alias("am_pm"),
        cal.is_business_hour(h).alias("is_business_hour"),
        cal.shift(h).alias("shift"),
    )
    return schemas.conform(rows, schemas.DIM_TIME)


def time_inserts(transformed: DataFrame, existing: DataFrame) -> DataFrame:
    return merge_insert_if_absent(time_rows(transformed), existing, ["time_key"])


def key_maps(
    dim_vehicle: DataFrame, dim_driver: DataFrame, dim_route: DataFrame, dim_customer: DataFrame
) -> dict[str, DataFrame]:
    """Source id -> surrogate key lookups (current rows for vehicle and driver).

    One row per source id, its smallest key, so a repeated dimension row
    never multiplies facts.
    """

    def unique(dim: DataFrame, natural: str, key: str) -> DataFrame:
        return dim.groupBy(natural).agg(F.min(key).alias(key))

    return {
        "vehicle": unique(dim_vehicle.where(F.col("is_current")), "vehicle_id", "vehicle_key"),
        "driver": unique(dim_driver.where(F.col("is_current")), "driver_id", "driver_key"),
        "route": unique(dim_route, "route_id", "route_key"),
        "customer": unique(dim_customer, "customer_name", "customer_key"),
    }
