"""Data-quality checks, table counts and the run summary.

Each check is also a one-row DataFrame of its own; the report computes all
five from one pass over deliveries and two over trips.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import metrics as m
from parcelflow.operators.scans import join_anti_count
from parcelflow.sources.tables import TABLE_NAMES, FleetTables

# Check ids and their descriptions, in report order.
CHECKS = [
    ("trips_vehicle", "Integridad referencial - Trips sin vehículo válido"),
    ("deliveries_trip", "Integridad referencial - Deliveries sin trip válido"),
    ("time_order", "Consistencia temporal - Trips con arrival < departure"),
    ("weight_capacity", "Consistencia de peso - Trips excediendo capacidad"),
    ("tracking_missing", "Entregas sin tracking number"),
]


def dq_trips_vehicle(trips: DataFrame, vehicles: DataFrame) -> DataFrame:
    return join_anti_count(trips, vehicles, "vehicle_id")


def dq_deliveries_trip(deliveries: DataFrame, trips: DataFrame) -> DataFrame:
    return join_anti_count(deliveries, trips, "trip_id")


def dq_time_order(trips: DataFrame) -> DataFrame:
    """Trips whose (non-null) arrival precedes their departure."""
    bad = F.col("arrival_datetime").isNotNull() & (F.col("arrival_datetime") < F.col("departure_datetime"))
    return trips.agg(F.count_if(bad).alias("violations"))


def dq_weight_capacity(trips: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Trips loaded above their vehicle's capacity (equi-join + residual filter)."""
    return (
        trips.select("vehicle_id", "total_weight_kg")
        .join(vehicles.select("vehicle_id", "capacity_kg"), "vehicle_id")
        .where(F.col("total_weight_kg") > F.col("capacity_kg"))
        .agg(F.count(F.lit(1)).alias("violations"))
    )


def dq_tracking_missing(deliveries: DataFrame) -> DataFrame:
    return deliveries.agg(F.count_if(m.empty_text("tracking_number")).alias("violations"))


def dq_report(t: FleetTables) -> DataFrame:
    """All five checks as rows (check_name, description, violations, ok).

    Trips meet their vehicles once for three checks. Deliveries are counted
    per trip once for two, so a hot trip is one row before the join.
    """
    vehicles = t.vehicles.select("vehicle_id", "capacity_kg", F.lit(True).alias("_known"))
    trips = t.trips.join(vehicles, "vehicle_id", "left").agg(
        F.count_if(F.col("_known").isNull()).alias("trips_vehicle"),
        F.count_if(F.col("arrival_datetime") < F.col("departure_datetime")).alias("time_order"),
        F.count_if(F.col("total_weight_kg") > F.col("capacity_kg")).alias("weight_capacity"),
    )
    per_trip = t.deliveries.groupBy("trip_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(m.empty_text("tracking_number")).alias("_untracked")
    )
    known = t.trips.select("trip_id", F.lit(True).alias("_known"))
    deliveries = per_trip.join(known, "trip_id", "left").agg(
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_rows"))), F.lit(0)).alias("deliveries_trip"),
        F.coalesce(F.sum("_untracked"), F.lit(0)).alias("tracking_missing"),
    )
    found = {name: frame for frame in (trips, deliveries) for name in frame.columns}
    both = [
        frame.select(
            F.inline(
                F.array(
                    *(
                        F.struct(
                            F.lit(check).alias("check_name"), F.lit(text).alias("description"),
                            F.col(check).cast("bigint").alias("violations"), (F.col(check) == 0).alias("ok"),
                        )
                        for check, text in CHECKS
                        if found[check] is frame
                    )
                )
            )
        )
        for frame in (trips, deliveries)
    ]
    return both[0].unionByName(both[1])


def validations_passed(report: DataFrame) -> bool:
    """True when every check of a report found no violation."""
    return bool(report.agg(F.bool_and("ok")).first()[0])


def dq_key_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys occurring more than once and the surplus rows they carry."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return counts.agg(
        F.count(F.lit(1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("surplus_rows"),
    )


def dq_fk(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Non-null fact keys without a dimension row."""
    dim_key = dim_key or fact_key
    keys = fact.where(F.col(fact_key).isNotNull()).select(F.col(fact_key).alias("_k"))
    return keys.join(dim.select(F.col(dim_key).alias("_k")), "_k", "left_anti").agg(
        F.count(F.lit(1)).alias("violations")
    )


def table_count(t: FleetTables) -> DataFrame:
    """Row count of each operational table plus a TOTAL row."""
    counts = None
    for name in TABLE_NAMES:
        one = t.table(name).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        counts = one if counts is None else counts.unionByName(one)
    total = counts.agg(F.sum("row_count").cast("bigint").alias("row_count")).select(
        F.lit("TOTAL").alias("table_name"), "row_count"
    )
    return counts.unionByName(total)


def deliveries_per_trip_stats(deliveries: DataFrame) -> DataFrame:
    """Average, minimum and maximum deliveries per trip (trips with at least one)."""
    per_trip = deliveries.groupBy("trip_id").agg(F.count(F.lit(1)).alias("delivery_count"))
    return per_trip.agg(
        F.avg("delivery_count").alias("avg_deliveries_per_trip"),
        F.min("delivery_count").alias("min_deliveries"),
        F.max("delivery_count").alias("max_deliveries"),
    )


def vehicle_activity(trips: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Per vehicle and type: trip count, last and first departure."""
    per_vehicle = trips.groupBy("vehicle_id").agg(
        F.count("trip_id").alias("trip_count"),
        F.max("departure_datetime").alias("last_trip"),
        F.min("departure_datetime").alias("first_trip"),
    )
    return per_vehicle.join(vehicles.select("vehicle_id", "vehicle_type"), "vehicle_id").select(
        "vehicle_id", "vehicle_type", "trip_count", "last_trip", "first_trip"
    )


def summary_report(t: FleetTables, report: DataFrame, generated_on: _dt.date | str) -> DataFrame:
    """One-row run summary: date, total rows, per-table counts, validation flag.

    Counts and check results are unioned into one small frame (six plus
    five rows) and reduced by a single aggregate.
    """
    counts = table_count(t).where(F.col("table_name") != "TOTAL").select(
        "table_name", "row_count", F.lit(None).cast("boolean").alias("ok")
    )
    checks = report.select(
        F.lit(None).cast("string").alias("table_name"), F.lit(None).cast("bigint").alias("row_count"), "ok"
    )
    entry = F.when(F.col("table_name").isNotNull(), F.struct("table_name", "row_count"))
    return counts.unionByName(checks).agg(
        F.lit(str(generated_on)).alias("generation_date"),
        F.sum("row_count").cast("bigint").alias("total_records"),
        F.map_from_entries(F.collect_list(entry)).alias("table_counts"),
        F.bool_and("ok").alias("validations_passed"),
    )


# Declared primary keys of the dimensions and the fact's
# foreign keys (fact column, dimension, dimension column).
DIMENSION_KEYS = [
    ("dim_date", "date_key"),
    ("dim_time", "time_key"),
    ("dim_vehicle", "vehicle_key"),
    ("dim_driver", "driver_key"),
    ("dim_route", "route_key"),
    ("dim_customer", "customer_key"),
]
FACT_FOREIGN_KEYS = [
    ("date_key", "dim_date", "date_key"),
    ("scheduled_time_key", "dim_time", "time_key"),
    ("delivered_time_key", "dim_time", "time_key"),
    ("vehicle_key", "dim_vehicle", "vehicle_key"),
    ("driver_key", "dim_driver", "driver_key"),
    ("route_key", "dim_route", "route_key"),
    ("customer_key", "dim_customer", "customer_key"),
]


def star_schema_report(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Key checks Spark does not enforce: one row per declared key.

    ``primary_key`` rows count surplus rows of duplicated keys (of the
    dimensions, and of deliveries in the fact); ``foreign_key`` rows count
    fact rows whose key has no dimension row. The fact is read once for all
    foreign keys.
    """
    unique = [
        dq_key_unique(frame, [key]).select(
            F.lit(table).alias("table_name"), F.lit(key).alias("key_column"),
            F.lit("primary_key").alias("check_kind"), F.col("surplus_rows").alias("violations"),
        )
        for table, key, frame in [
            *((table, key, dims[table]) for table, key in DIMENSION_KEYS),
            ("fact_deliveries", "delivery_id", fact),
        ]
    ]
    rows = fact.select(*(column for column, _, _ in FACT_FOREIGN_KEYS))
    for column, table, key in FACT_FOREIGN_KEYS:
        known = dims[table].select(F.col(key).alias(column)).distinct().withColumn(f"_has_{column}", F.lit(True))
        rows = rows.join(known, column, "left")
    missing = rows.agg(
        *(
            F.count_if(F.col(column).isNotNull() & F.col(f"_has_{column}").isNull()).alias(column)
            for column, _, _ in FACT_FOREIGN_KEYS
        )
    )
    foreign = missing.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit("fact_deliveries").alias("table_name"), F.lit(column).alias("key_column"),
                        F.lit("foreign_key").alias("check_kind"), F.col(column).cast("bigint").alias("violations"),
                    )
                    for column, _, _ in FACT_FOREIGN_KEYS
                )
            )
        )
    )
    report = unique[0]
    for r in [*unique[1:], foreign]:
        report = report.unionByName(r)
    return report
