"""Registry of runnable queries over the test tables.

Each entry maps a name from SURVEY §2 to a function of the operational
tables. The same registry feeds ``__spark_entry__.queries()``, ``bench.py``
and the tests; ``parcelflow.plans.oracle_sql`` holds the DuckDB text of the
same names.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow import schemas
from parcelflow.functions import calendar as cal
from parcelflow.functions import metrics as m
from parcelflow.operators import expansion, fact, history, integrity, keys, quality, reports, scans
from parcelflow.operators.etl import add_group_size
from parcelflow.plans import load_state
from parcelflow.plans.first_load import FirstLoad, customers_after_two_loads
from parcelflow.plans.pipeline import run_pipeline
from parcelflow.session import ensure_checkpoint_dir
from parcelflow.sinks.warehouse import Warehouse
from parcelflow.sources.driver_tables import DEFAULT_AS_OF, fleet_tables_from_driver_data
from parcelflow.sources.staging import raw_field, stage_raw_json
from parcelflow.sources.tables import TABLE_NAMES, FleetTables

AS_OF: _dt.date = DEFAULT_AS_OF
# A route pair that exists in the test tables (origin region, destination nation).
ROUTE_PAIR = ("AMERICA", "NATION_1")

TableQuery = Callable[[FleetTables], DataFrame]

REPORTS: dict[str, TableQuery] = {
    "vehicles_by_type": lambda t: reports.vehicles_by_type(t.vehicles),
    "expiring_licenses": lambda t: reports.expiring_licenses(t.drivers, AS_OF),
    "trips_by_status": lambda t: reports.trips_by_status(t.trips),
    "deliveries_by_city": lambda t: reports.deliveries_by_city(t.deliveries, t.trips, t.routes, AS_OF),
    "completed_trips_by_driver": lambda t: reports.completed_trips_by_driver(t.drivers, t.trips),
    "avg_monthly_deliveries": lambda t: reports.avg_monthly_deliveries(
        t.deliveries, t.trips, t.drivers, AS_OF
    ),
    "fuel_per_km": lambda t: reports.fuel_per_km(t.routes, t.trips),
    "late_by_weekday": lambda t: reports.late_by_weekday(t.deliveries),
    "maintenance_cost_per_km": lambda t: reports.maintenance_cost_per_km(
        t.trips, t.routes, t.vehicles, t.maintenance
    ),
    "driver_ranking": lambda t: reports.driver_ranking(t.deliveries, t.trips, t.drivers, AS_OF),
    "trip_trend": lambda t: reports.trip_trend(t.trips),
    "hour_weekday_pivot": lambda t: reports.hour_weekday_pivot(t.deliveries),
}

INTEGRITY: dict[str, TableQuery] = {
    "scan_table": lambda t: t.trips,
    "filter_time_order": lambda t: integrity.filter_time_order(t.trips),
    "max_load_by_type": lambda t: integrity.max_load_by_type(t.trips, t.vehicles),
    "min_load_by_type": lambda t: integrity.min_load_by_type(t.trips, t.vehicles),
    "filter_route_pair": lambda t: integrity.filter_route_pair(t.routes, *ROUTE_PAIR),
    "scan_active_vehicles": lambda t: scans.scan_active_vehicles(t.vehicles),
    "scan_active_drivers": lambda t: scans.scan_active_drivers(t.drivers),
    "scan_routes_projection": lambda t: scans.scan_routes_projection(t.routes),
    "trips_with_destination": lambda t: scans.trips_with_destination(t.trips, t.routes),
}



def _load(t: FleetTables, staged: bool = False) -> FirstLoad:
    return FirstLoad(t, AS_OF, staged=staged)


def _after_two_batches(t: FleetTables) -> Warehouse:
    """A warehouse loaded in two batches.

    The first sees two lines of every trip, and every seventh trip's
    deliveries a day before their final date; the second sees everything.
    """
    spark, wh = t.deliveries.sparkSession, _new_warehouse(t)
    line = F.expr("delivery_id div 100000 % 10")
    early = F.col("scheduled_datetime") - F.expr("INTERVAL 1 DAY")
    first = t.deliveries.where(line <= 2).withColumn(
        "scheduled_datetime", F.when(F.col("trip_id") % 7 == 0, early).otherwise(F.col("scheduled_datetime"))
    )
    tables = {name: t.table(name) for name in TABLE_NAMES}
    run_pipeline(spark, FleetTables.from_frames(**(tables | {"deliveries": first})), wh, AS_OF, batch_id=1)
    run_pipeline(spark, t, wh, AS_OF, batch_id=2)
    return wh


def _new_warehouse(t: FleetTables) -> Warehouse:
    spark = t.deliveries.sparkSession
    return Warehouse(spark, f"{ensure_checkpoint_dir(spark)}/warehouse-{uuid.uuid4().hex}")


def _earlier(t: FleetTables) -> FleetTables:
    """The fleet before some of its dependencies changed: other tolls, drivers and vehicles that are not there yet."""
    tables = {name: t.table(name) for name in TABLE_NAMES}
    toll = F.when(F.col("route_id") % 3 == 0, F.col("toll_cost") + 5000).otherwise(F.col("toll_cost"))
    return FleetTables.from_frames(**tables | {
        "routes": t.routes.withColumn("toll_cost", toll.cast("decimal(10,2)")),
        "drivers": t.drivers.where("driver_id % 5 <> 0"),
        "vehicles": t.vehicles.where("vehicle_id % 7 <> 0"),
    })


def _facts_after_dependency_changes(t: FleetTables) -> DataFrame:
    """The fact after a second batch over the same deliveries, once tolls changed and drivers and vehicles turned up."""
    spark, wh = t.deliveries.sparkSession, _new_warehouse(t)
    run_pipeline(spark, _earlier(t), wh, AS_OF, batch_id=1)
    run_pipeline(spark, t, wh, AS_OF, batch_id=2)
    return wh.read("fact_deliveries").select(
        *(c for c in fact.FACT_COLUMNS if c not in ("customer_key", "etl_batch_id"))
    )


def _rerun_changes_nothing(t: FleetTables) -> DataFrame:
    """Deliveries by what became of them, and how many rows a second run over the same tables looked at and loaded."""
    spark, wh = t.deliveries.sparkSession, _new_warehouse(t)
    run_pipeline(spark, t, wh, AS_OF, batch_id=1)
    again = run_pipeline(spark, t, wh, AS_OF, batch_id=2)
    state = load_state.newest_state(wh.read("load_state"))
    outcome = F.when(F.col("date_key").isNotNull(), F.lit("loaded")).otherwise(F.col("reason"))
    return state.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n")).withColumns({
        "rerun_extracted": F.lit(again.records_extracted).cast("bigint"),
        "rerun_loaded": F.lit(again.records_loaded).cast("bigint"),
    })


def _vehicle_versions(t: FleetTables) -> DataFrame:
    """The history of vehicles seen on two days, half of them changed in between and some new."""
    first = t.vehicles.where("vehicle_id % 7 <> 0").withColumn(
        "status", F.when(F.col("vehicle_id") % 2 == 0, F.lit("new")).otherwise(F.col("status"))
    )
    spark, key, schema = t.deliveries.sparkSession, "vehicle_id", schemas.VEHICLE_HISTORY
    empty = spark.createDataFrame([], schema)
    before = history.close_out(empty, first, key, AS_OF - _dt.timedelta(days=90), schema)
    return history.close_out(before, t.vehicles, key, AS_OF - _dt.timedelta(days=45), schema)


def _trips_by_version(t: FleetTables) -> DataFrame:
    trips = t.trips.select("trip_id", "vehicle_id", "departure_datetime")
    dated = history.valid_at(trips, _vehicle_versions(t), "vehicle_id", "departure_datetime", ["version", "status"])
    return dated.groupBy("vehicle_id", "version", "status").agg(F.count(F.lit(1)).alias("num_viajes"))


def _facts_of_two_batches(t: FleetTables) -> DataFrame:
    return _after_two_batches(t).read("fact_deliveries").select(
        *(c for c in fact.FACT_COLUMNS if c not in ("customer_key", "etl_batch_id"))
    )


def _totals_of_two_batches(t: FleetTables) -> DataFrame:
    return _after_two_batches(t).read("daily_totals").drop("etl_batch_id")


ETL: dict[str, TableQuery] = {
    "extract_daily": lambda t: _load(t).extracted(),
    "transform_all": lambda t: _load(t).transformed(),
    "build_dim_vehicle": lambda t: _load(t).dim_vehicle(),
    "build_dim_driver": lambda t: _load(t).dim_driver(),
    "build_dim_route": lambda t: _load(t).dim_route(),
    "build_dim_customer": lambda t: _load(t, staged=True).dim_customer(),
    "build_dim_date": lambda t: _load(t).dim_date(),
    "build_dim_time": lambda t: _load(t).dim_time(),
    "load_fact": lambda t: _load(t, staged=True).fact(),
    "daily_totals": lambda t: _load(t, staged=True).totals(),
    "sales_view": lambda t: _load(t, staged=True).sales_view(),
    "operations_view": lambda t: _load(t, staged=True).operations_view(),
    "fact_after_two_batches": _facts_of_two_batches,
    "totals_after_two_batches": _totals_of_two_batches,
    "fact_after_dependency_changes": _facts_after_dependency_changes,
    "rerun_changes_nothing": _rerun_changes_nothing,
    "vehicle_history": _vehicle_versions,
    "trips_by_vehicle_version": _trips_by_version,
    "merge_insert_if_absent": lambda t: customers_after_two_loads(
        t, AS_OF - _dt.timedelta(days=60), AS_OF
    ),
    "dedupe_keep_first": lambda t: keys.dedupe_keep_first(
        t.deliveries, ["delivery_id"], ["scheduled_datetime"]
    ),
}




def _fk_check(t: FleetTables) -> DataFrame:
    load = _load(t, staged=True)
    return quality.dq_fk(load.fact(), load.dim_customer(), "customer_key")


def _star_schema(t: FleetTables) -> DataFrame:
    load = _load(t, staged=True)
    dims = {
        "dim_date": load.dim_date(), "dim_time": load.dim_time(), "dim_vehicle": load.dim_vehicle(),
        "dim_driver": load.dim_driver(), "dim_route": load.dim_route(), "dim_customer": load.dim_customer(),
    }
    return quality.star_schema_report(load.fact(), dims)


def _slots(t: FleetTables) -> DataFrame:
    per_trip = t.deliveries.groupBy("trip_id").agg(F.count(F.lit(1)).alias("n"))
    return expansion.slot_times(t.trips, per_trip)


def _allocation(t: FleetTables) -> DataFrame:
    rows = t.deliveries.select("delivery_id", "trip_id", "package_weight_kg").join(
        t.trips.select("trip_id", "total_weight_kg"), "trip_id"
    )
    return expansion.proportional_allocation(rows, "trip_id", "package_weight_kg", "total_weight_kg").select(
        "delivery_id", "trip_id", "allocated"
    )


def _reverse_pair_distance(t: FleetTables) -> DataFrame:
    legs = t.trips.select("trip_id", "route_id").join(
        t.routes.select("route_id", F.col("destination_city").alias("from_city"), F.col("origin_city").alias("to_city")),
        "route_id",
    )
    pairs = t.routes.select(
        F.col("origin_city").alias("a"), F.col("destination_city").alias("b"), "distance_km"
    )
    return keys.lookup_symmetric_default(legs, "from_city", "to_city", pairs, "distance_km", 500).select(
        "trip_id", "from_city", "to_city", "distance_km"
    )


def _time_keys(t: FleetTables) -> DataFrame:
    d = t.deliveries
    return (
        d.select(cal.time_key("scheduled_datetime").alias("time_key"))
        .union(d.select(cal.time_key("delivered_datetime").alias("time_key")))
        .where(F.col("time_key").isNotNull())
        .distinct()
    )


def _summary(t: FleetTables) -> DataFrame:
    row = quality.summary_report(t, quality.dq_report(t), AS_OF)
    counts = (F.col("table_counts")[name].alias(name) for name in TABLE_NAMES)
    return row.select("generation_date", "total_records", *counts, "validations_passed")


def _staged_fields(t: FleetTables) -> DataFrame:
    """The JSON landing table of all deliveries, read back by path."""
    kinds = {"delivery_id": "bigint", "trip_id": "bigint", "customer_name": "string", "package_weight_kg": "decimal(10,2)", "delivery_status": "string"}
    staged = stage_raw_json(t.deliveries, _dt.datetime.combine(AS_OF, _dt.time()))
    return staged.select(*(raw_field(f"$.{name}", kind).alias(name) for name, kind in kinds.items()))


def _parsed(t: FleetTables) -> DataFrame:
    at, fmt = F.col("scheduled_datetime"), "dd/MM/yyyy HH:mm"
    return t.deliveries.select(
        "delivery_id",
        cal.parse_datetime(at.cast("string")).alias("parsed"),
        cal.parse_datetime(F.date_format(at, fmt), fmt).alias("parsed_format"),
        cal.parse_datetime(F.concat(F.lit("x"), at.cast("string"))).alias("unparseable"),
    )


QUALITY: dict[str, TableQuery] = {
    "dq_report": lambda t: quality.dq_report(t),
    "dq_key_unique": lambda t: quality.dq_key_unique(t.deliveries, ["delivery_id"]),
    "dq_fk": _fk_check,
    "dq_star_schema": _star_schema,
    "table_count": lambda t: quality.table_count(t),
    "deliveries_per_trip_stats": lambda t: quality.deliveries_per_trip_stats(t.deliveries),
    "vehicle_activity": lambda t: quality.vehicle_activity(t.trips, t.vehicles),
    "batch_count": lambda t: (lambda load: fact.batch_count(load.fact(), load.batch_id))(_load(t, staged=True)),
    "summary_report": _summary,
}

PRIMITIVES: dict[str, TableQuery] = {
    "filter_recent": lambda t: scans.filter_recent(t.deliveries, "delivered_datetime", AS_OF, days=90).select(
        "delivery_id", "trip_id", "delivered_datetime"
    ),
    "drop_null_rows": lambda t: scans.drop_null_rows(
        t.deliveries, ["delivered_datetime", "scheduled_datetime"]
    ).select("delivery_id", "scheduled_datetime", "delivered_datetime"),
    "filter_weight_range": lambda t: scans.filter_weight_range(t.deliveries).select(
        "delivery_id", "package_weight_kg"
    ),
    "filter_status": lambda t: scans.filter_status(t.trips, "status", "completed").select(
        "trip_id", "vehicle_id", "driver_id"
    ),
    "select_rename": lambda t: scans.select_rename(t.vehicles, upper=True),
    "group_size_broadcast": lambda t: add_group_size(
        t.deliveries.select("delivery_id", "trip_id"), "trip_id", "deliveries_in_trip"
    ),
    "union_time_keys": _time_keys,
}

REAIMED: dict[str, TableQuery] = {
    "staging_json": _staged_fields,
    "parse_datetime": _parsed,
    "tracking_code": lambda t: t.trips.select(
        "trip_id", m.tracking_code(F.year("departure_datetime"), "trip_id").alias("tracking_code")
    ),
    "address_text": lambda t: t.routes.select("route_id", m.address_text("route_code", "destination_city").alias("address")),
    "spread_dates": lambda t: expansion.spread_dates(quality.vehicle_activity(t.trips, t.vehicles)),
    "slot_times": _slots,
    "proportional_allocation": _allocation,
    "lookup_symmetric_default": _reverse_pair_distance,
    "format_code": lambda t: t.drivers.select("driver_id", m.format_code("EMP", "driver_id", 4).alias("employee_code")),
    "toll_by_band": lambda t: t.routes.select("route_id", "distance_km", m.toll_by_band("distance_km").alias("toll_cost")),
    "trip_status": lambda t: expansion.trip_status_as_of(t.trips, AS_OF),
    "concat_text": lambda t: t.maintenance.select(
        "maintenance_id", m.maintenance_description("maintenance_type", "maintenance_date").alias("description")
    ),
}


def table_queries() -> dict[str, TableQuery]:
    out: dict[str, TableQuery] = {}
    for group in (REPORTS, INTEGRITY, ETL, QUALITY, PRIMITIVES, REAIMED):
        out.update(group)
    return out


def bind(fn: TableQuery) -> Callable[[SparkSession, str], DataFrame]:
    """Turn a table query into ``(spark, sf_dir) -> DataFrame``."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(fleet_tables_from_driver_data(spark, sf_dir))

    return run


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: bind(fn) for name, fn in table_queries().items()}
