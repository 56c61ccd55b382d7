"""The twelve operational reports (Query 1 to Query 12).

Each report is ``DataFrames -> DataFrame`` with an explicit ``as_of`` date.
Column names are the reference's output names in lower case.

Scale notes. Deliveries are the biggest table and trips the second; both
are hash-shuffled on ``trip_id`` whenever they meet. Reports that only need
counts per trip aggregate deliveries *before* that join, so the shuffle
carries one partial row per (trip, group) and map task instead of every
delivery, and a trip holding a third of all deliveries collapses to a few
rows on the map side instead of landing whole in one join task. Drivers,
routes and vehicles are small dimensions: the planner broadcasts them when
their measured size is under the broadcast threshold, and AQE re-plans from
runtime sizes otherwise.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.functions import calendar as cal

DELIVERED = "delivered"
COMPLETED = "completed"
ACTIVE = "active"

# Query 12 column names, Monday first, with PostgreSQL weekday
# numbers (0 = Sunday).
PIVOT_DAYS = [
    ("lunes", 1),
    ("martes", 2),
    ("miercoles", 3),
    ("jueves", 4),
    ("viernes", 5),
    ("sabado", 6),
    ("domingo", 0),
]


def vehicles_by_type(vehicles: DataFrame) -> DataFrame:
    """Query 1: number of vehicles per type."""
    return vehicles.groupBy("vehicle_type").agg(F.count("vehicle_id").alias("num_vehiculos"))


def expiring_licenses(drivers: DataFrame, as_of: _dt.date | str, days: int = 60) -> DataFrame:
    """Query 2: active drivers whose licence expires in under ``days`` days.

    There is no lower bound: already expired licences qualify too.
    """
    before = cal.as_date(as_of) + _dt.timedelta(days=days)  # a literal, so the filter reaches the scan
    return (
        drivers.where((F.col("status") == ACTIVE) & (F.col("license_expiry") < F.lit(before)))
        .select("driver_id", "first_name", "last_name", "license_expiry", "status")
        .orderBy(F.asc_nulls_last("license_expiry"))
    )


def trips_by_status(trips: DataFrame) -> DataFrame:
    """Query 3: number of trips per status."""
    return trips.groupBy("status").agg(F.count("trip_id").alias("num_viajes"))


def _deliveries_per_trip(deliveries: DataFrame, *group_cols) -> DataFrame:
    """Partial counts of deliveries per trip (and extra keys) before a trip join."""
    return deliveries.groupBy("trip_id", *group_cols).agg(F.count("delivery_id").alias("_n"))


def deliveries_by_city(
    deliveries: DataFrame, trips: DataFrame, routes: DataFrame, as_of: _dt.date | str, days: int = 60
) -> DataFrame:
    """Query 4: deliveries per destination city in the last ``days`` days."""
    since = cal.days_before(as_of, days)
    per_trip = _deliveries_per_trip(deliveries.where(F.col("delivered_datetime") >= F.lit(since)))
    return (
        per_trip.join(trips.select("trip_id", "route_id"), "trip_id")
        .join(routes.select("route_id", "destination_city"), "route_id")
        .groupBy("destination_city")
        .agg(F.sum("_n").alias("num_entregas"))
        .orderBy(F.desc_nulls_first("num_entregas"))
    )


def completed_trips_by_driver(drivers: DataFrame, trips: DataFrame) -> DataFrame:
    """Query 5: completed trips per active driver; drivers without any are absent."""
    per_driver = (
        trips.where(F.col("status") == COMPLETED)
        .groupBy("driver_id")
        .agg(F.count("trip_id").alias("num_viajes_completados"))
    )
    return (
        drivers.where(F.col("status") == ACTIVE)
        .select("driver_id", "first_name", "last_name")
        .join(per_driver, "driver_id")
        .orderBy(F.desc_nulls_first("num_viajes_completados"))
    )


def _recent_delivered(deliveries: DataFrame, as_of: _dt.date | str, months: int) -> DataFrame:
    since = cal.months_before(as_of, months)
    return deliveries.where(
        (F.col("delivery_status") == DELIVERED) & (F.col("delivered_datetime") >= F.lit(since))
    )


def avg_monthly_deliveries(
    deliveries: DataFrame, trips: DataFrame, drivers: DataFrame, as_of: _dt.date | str, months: int = 6
) -> DataFrame:
    """Query 6: per active driver, the mean of monthly delivery counts.

    Months are grouped by month number (no year), as in the reference; a
    month without deliveries does not count as zero.
    """
    per_trip = _deliveries_per_trip(
        _recent_delivered(deliveries, as_of, months).withColumn("month", F.month("delivered_datetime")),
        "month",
    )
    per_driver_month = (
        per_trip.join(trips.select("trip_id", "driver_id"), "trip_id")
        .groupBy("driver_id", "month")
        .agg(F.sum("_n").alias("num_entregas"))
    )
    active = drivers.where(F.col("status") == ACTIVE).select("driver_id", "first_name", "last_name")
    return (
        per_driver_month.join(active, "driver_id")
        .groupBy("driver_id", "first_name", "last_name")
        .agg(
            F.avg(F.col("num_entregas").cast("decimal(20,0)")).cast("decimal(10,2)").alias("prom_entregas")
        )
    )


def fuel_per_km(routes: DataFrame, trips: DataFrame) -> DataFrame:
    """Query 7: distance, fuel and litres per km of each route over all its trips."""
    per_route = trips.groupBy("route_id").agg(
        F.count(F.lit(1)).alias("_trips"),
        F.sum("fuel_consumed_liters").alias("consumo_total_combustible_lt"),
    )
    joined = routes.select("route_id", "origin_city", "destination_city", "distance_km").join(
        per_route, "route_id"
    )
    km = (F.col("distance_km") * F.col("_trips")).cast("decimal(20,2)")
    return (
        joined.select(
            "route_id",
            "origin_city",
            "destination_city",
            km.alias("kilom_recorridos"),
            F.col("consumo_total_combustible_lt").cast("decimal(20,2)").alias("consumo_total_combustible_lt"),
        )
        .withColumn(
            "consumo_por_km",
            (F.col("consumo_total_combustible_lt") / F.col("kilom_recorridos")).cast("decimal(10,4)"),
        )
        .orderBy(F.desc_nulls_first("consumo_por_km"))
    )


def late_by_weekday(deliveries: DataFrame, threshold_minutes: int = 60, late_only: bool = False) -> DataFrame:
    """Query 8: delivered rows off schedule by at least an hour, per weekday.

    The reference compares the *absolute* difference, so early deliveries
    count too; ``late_only=True`` keeps only late ones. Rows are ordered by
    the weekday of each group's earliest delivery (0 = Sunday first).
    The threshold is compared in whole microseconds (exact, no division per
    row). Grouping is on the integer weekday (one-to-one with the name); the
    name is formatted once per group, not once per row.
    """
    micros = cal.micros_between("scheduled_datetime", "delivered_datetime")
    off = micros if late_only else F.abs(micros)
    return (
        deliveries.where((F.col("delivery_status") == DELIVERED) & (off >= threshold_minutes * 60_000_000))
        .groupBy(cal.pg_dow("delivered_datetime").alias("_dow"))
        .agg(
            F.count("delivery_id").alias("num_pedidos_retrasados"),
            F.min("delivered_datetime").alias("_first"),
        )
        .select(cal.weekday_name_pg("_first").alias("dia_semana"), "num_pedidos_retrasados", "_dow")
        .orderBy(F.asc_nulls_last("_dow"))
        .drop("_dow")
    )


def maintenance_cost_per_km(
    trips: DataFrame, routes: DataFrame, vehicles: DataFrame, maintenance: DataFrame
) -> DataFrame:
    """Query 9: maintenance cost per km of completed trips, per vehicle type.

    Trips are counted per vehicle and route before any join, and both sides are
    aggregated per vehicle before they meet, so maintenance
    rows never multiply trip rows. Vehicles missing on either side drop out
    (inner join), as in the reference.
    """
    per_route = (
        trips.where(F.col("status") == COMPLETED)
        .groupBy("vehicle_id", "route_id")
        .agg(F.count("trip_id").alias("_trips"))
    )
    km = (
        per_route.join(routes.select("route_id", "distance_km"), "route_id")
        .groupBy("vehicle_id")
        .agg(
            F.sum("_trips").alias("cant_viajes"),
            F.sum(F.col("distance_km") * F.col("_trips").cast("decimal(20,0)")).alias("kilom_recorridos"),
        )
        .join(vehicles.select("vehicle_id", "vehicle_type"), "vehicle_id")
    )
    upkeep = maintenance.groupBy("vehicle_id").agg(
        F.count("maintenance_id").alias("mantenimientos"), F.sum("cost").alias("costo_mantenimiento")
    )
    totals = (
        km.join(upkeep, "vehicle_id")
        .groupBy("vehicle_type")
        .agg(
            F.sum("cant_viajes").alias("total_viajes"),
            F.sum("costo_mantenimiento").cast("decimal(38,2)").alias("costo_total"),
            F.sum("kilom_recorridos").cast("decimal(38,2)").alias("total_km"),
        )
    )
    ratio = F.col("costo_total").cast("decimal(20,2)") / F.nullif(F.col("total_km").cast("decimal(20,2)"), F.lit(0))
    return totals.withColumn("costo_mante_porkm", F.round(ratio, 6).cast("decimal(20,6)"))


def driver_ranking(
    deliveries: DataFrame,
    trips: DataFrame,
    drivers: DataFrame,
    as_of: _dt.date | str,
    months: int = 6,
    top: int = 3,
    lang: str = "en",
) -> DataFrame:
    """Query 10: top drivers per month by delivered count (DENSE_RANK, ties kept).

    Ranks are computed per calendar month; the output labels the month by
    name and is ordered by that name descending, as in the reference.
    """
    recent = _recent_delivered(deliveries, as_of, months)
    per_trip = (
        recent.groupBy("trip_id", cal.month_trunc("delivered_datetime").alias("_month"))
        .agg(F.count("delivery_id").alias("_n"), F.bit_or(cal.day_mask("delivered_datetime")).alias("_mask"))
    )
    # days as bits of a mask: they add up like the counts, with no row per day
    metrics = (
        per_trip.join(trips.select("trip_id", "driver_id"), "trip_id")
        .groupBy("_month", "driver_id")
        .agg(F.sum("_n").alias("num_entregas"), cal.days_in_mask(F.bit_or("_mask")).alias("_days"))
        .join(
            drivers.where(F.col("status") == ACTIVE).select("driver_id", "first_name", "last_name"),
            "driver_id",
        )
    )
    rank = F.dense_rank().over(Window.partitionBy("_month").orderBy(F.desc("num_entregas")))
    return (
        metrics.select(
            cal.month_name("_month", lang).alias("mes"),
            "first_name",
            "last_name",
            "num_entregas",
            (F.col("num_entregas") / F.col("_days").cast("double"))
            .cast("decimal(10,2)")
            .alias("promedio_entregas_diario"),
            rank.alias("posicion_ranking"),
        )
        .where(F.col("posicion_ranking") <= top)
        .orderBy(F.desc_nulls_first("mes"), F.asc_nulls_last("posicion_ranking"))
    )


def trip_trend(trips: DataFrame, include_next: bool = False) -> DataFrame:
    """Query 11: completed trips per month with previous month, growth and projection.

    growth = round((cur - prev) / prev * 100), projection = round(cur * (1 + growth
    ratio)) = round(cur^2 / prev); both NULL without a non-zero previous month.
    The window has no partition on purpose: its input is one row per month.
    """
    monthly = (
        trips.where(F.col("status") == COMPLETED)
        .groupBy(cal.month_trunc("arrival_datetime").alias("_mes"))
        .agg(F.count("trip_id").alias("viajes_actuales"))
    )
    order = Window.orderBy(F.asc_nulls_last("_mes"))
    trend = monthly.select(
        "_mes",
        "viajes_actuales",
        F.lag("viajes_actuales").over(order).alias("viajes_mes_anterior"),
        F.lead("viajes_actuales").over(order).alias("viajes_mes_siguiente"),
    )
    cur = F.col("viajes_actuales").cast("decimal(20,0)")
    prev = F.nullif(F.col("viajes_mes_anterior"), F.lit(0)).cast("decimal(20,0)")
    out = trend.select(
        "_mes",
        cal.period_label("_mes").alias("periodo"),
        "viajes_actuales",
        "viajes_mes_anterior",
        F.round((cur - prev) * 100 / prev, 0).cast("bigint").alias("porcentaje_crecimiento"),
        F.round(cur * cur / prev, 0).cast("bigint").alias("proyeccion_sig_mes"),
        "viajes_mes_siguiente",
    )
    if not include_next:
        out = out.drop("viajes_mes_siguiente")
    return out.orderBy(F.desc_nulls_first("_mes")).drop("_mes")


def hour_weekday_pivot(deliveries: DataFrame) -> DataFrame:
    """Query 12: delivered rows per hour, one column per weekday, zero when none.

    One pass with conditional counts (``pivot`` would give NULL, not 0).
    """
    dow = cal.pg_dow("delivered_datetime")
    return (
        deliveries.where(F.col("delivery_status") == DELIVERED)
        .groupBy(F.hour("delivered_datetime").alias("hora"))
        .agg(*[F.count_if(dow == num).alias(name) for name, num in PIVOT_DAYS])
        .orderBy(F.asc_nulls_last("hora"))
    )


def all_reports(t, as_of: _dt.date | str, lang: str = "en") -> dict[str, DataFrame]:
    """The twelve reports over a :class:`~parcelflow.sources.tables.FleetTables`, by query number."""
    return {
        "q01_vehicles_by_type": vehicles_by_type(t.vehicles),
        "q02_expiring_licenses": expiring_licenses(t.drivers, as_of),
        "q03_trips_by_status": trips_by_status(t.trips),
        "q04_deliveries_by_city": deliveries_by_city(t.deliveries, t.trips, t.routes, as_of),
        "q05_completed_trips_by_driver": completed_trips_by_driver(t.drivers, t.trips),
        "q06_avg_monthly_deliveries": avg_monthly_deliveries(t.deliveries, t.trips, t.drivers, as_of),
        "q07_fuel_per_km": fuel_per_km(t.routes, t.trips),
        "q08_late_by_weekday": late_by_weekday(t.deliveries),
        "q09_maintenance_cost_per_km": maintenance_cost_per_km(t.trips, t.routes, t.vehicles, t.maintenance),
        "q10_driver_ranking": driver_ranking(t.deliveries, t.trips, t.drivers, as_of, lang=lang),
        "q11_trip_trend": trip_trend(t.trips),
        "q12_hour_weekday_pivot": hour_weekday_pivot(t.deliveries),
    }
