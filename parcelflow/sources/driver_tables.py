"""Fleet tables derived from the TPC-H-style test tables.

The test data has no fleet tables, so each operational table is a pure
column projection of one test table (routes: nation joined to region):

    vehicles    <- supplier          drivers     <- customer
    routes      <- nation x region   trips       <- orders
    deliveries  <- lineitem          maintenance <- events

Every expression is deterministic and the same text exists in the DuckDB
oracle (``parcelflow.plans.oracle_sql``), so both engines see equal rows.
Only ``routes`` joins (25 x 5 rows); ``deliveries`` takes its customer
name from the line's part key instead of joining orders and customers, which
would add a second shuffle of the biggest table for one text column.

Fixed shares of the rows break a rule each, so that filters, outer joins and
checks have something to find: trips without a vehicle row, without a driver
or with an arrival before the departure, and deliveries without a trip or a
customer name, or with a weight on the edge of the allowed range.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow import schemas
from parcelflow.sources.tables import FleetTables

# Fixed values of the mapping: vehicle classes by supplier key modulo 4
# (type, capacity kg, fuel), in class order 0..3.
VEHICLE_CLASSES = [
    ("Camión Grande", 5000, "diesel"),
    ("Camión Mediano", 3000, "diesel"),
    ("Van", 1500, "gasolina"),
    ("Motocicleta", 50, "gasolina"),
]
ACQUISITION_BASE = _dt.date(1996, 1, 15)
LICENSE_EXPIRY_BASE = _dt.date(2001, 9, 1)
HIRE_BASE = _dt.date(1996, 3, 10)
DEFAULT_AS_OF = _dt.date(2001, 9, 1)


def _minutes(expr: Column) -> Column:
    """An interval of ``expr`` whole minutes."""
    return F.make_dt_interval(F.lit(0), F.lit(0), expr.cast("int"), F.lit(0))


# Declared schemas of the test tables (read without inference).
SOURCE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
    "props STRING",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCE_SCHEMAS[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))


def vehicles_from_supplier(supplier: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")
    cls = k % 4

    def by_class(idx: int) -> Column:
        expr = F.when(cls == 0, F.lit(VEHICLE_CLASSES[0][idx]))
        for i in (1, 2):
            expr = expr.when(cls == i, F.lit(VEHICLE_CLASSES[i][idx]))
        return expr.otherwise(F.lit(VEHICLE_CLASSES[3][idx]))

    return supplier.select(
        k.alias("vehicle_id"),
        F.concat(F.lit("PLT"), F.lpad(k.cast("string"), 4, "0")).alias("license_plate"),
        by_class(0).alias("vehicle_type"),
        by_class(1).cast("decimal(10,2)").alias("capacity_kg"),
        F.when(cls < 2, "diesel").otherwise("gasolina").alias("fuel_type"),
        F.date_add(F.lit(ACQUISITION_BASE), (k % 1500).cast("int")).alias("acquisition_date"),
        F.when(k % 10 == 9, "maintenance").otherwise("active").alias("status"),
    )


def drivers_from_customer(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        k.alias("driver_id"),
        F.concat(F.lit("EMP"), F.lpad(k.cast("string"), 5, "0")).alias("employee_code"),
        F.concat(F.lit(" "), F.col("c_mktsegment")).alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.lit(None).cast("string").alias("license_number"),
        F.date_add(F.lit(LICENSE_EXPIRY_BASE), (k % 120 - 30).cast("int")).alias("license_expiry"),
        F.lit(None).cast("string").alias("phone"),
        F.date_add(F.lit(HIRE_BASE), (k % 1500).cast("int")).alias("hire_date"),
        F.when(k % 20 == 0, "inactive").otherwise("active").alias("status"),
    )


def routes_from_nation(nation: DataFrame, region: DataFrame) -> DataFrame:
    n = F.col("n_nationkey")
    distance = F.lit(120) + F.lit(37.25).cast("decimal(4,2)") * n
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        n.cast("bigint").alias("route_id"),
        F.concat(F.lit("R"), F.lpad(n.cast("string"), 3, "0")).alias("route_code"),
        F.col("r_name").alias("origin_city"),
        F.col("n_name").alias("destination_city"),
        distance.cast("decimal(10,2)").alias("distance_km"),
        (F.lit(2) + F.lit(0.5).cast("decimal(2,1)") * n).cast("decimal(5,2)").alias(
            "estimated_duration_hours"
        ),
        (F.floor(distance / 100) * 15000).cast("decimal(10,2)").alias("toll_cost"),
    )


def trips_from_orders(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    start = k * 7 % 1440
    is_open = F.col("o_orderstatus") == "O"
    return orders.select(
        k.alias("trip_id"),
        F.when(k % 211 == 5, F.lit(-1)).otherwise(F.floor(F.col("o_custkey") / 15)).cast("bigint").alias("vehicle_id"),
        F.when(k % 97 != 3, F.col("o_custkey")).alias("driver_id"),
        (k % 25).alias("route_id"),
        (F.col("o_orderdate") + _minutes(start)).alias("departure_datetime"),
        F.when(
            ~is_open,
            F.col("o_orderdate") + _minutes(F.when(k % 173 == 7, start - 30).otherwise(start + 60 + k % 600)),
        ).alias("arrival_datetime"),
        F.when(k % 50 == 0, F.lit(0)).otherwise(10 + k % 90).cast("decimal(10,2)").alias(
            "fuel_consumed_liters"
        ),
        (20 + k % 5000).cast("decimal(10,2)").alias("total_weight_kg"),
        F.when(is_open, "in_progress").otherwise("completed").alias("status"),
    )


def deliveries_from_lineitem(lineitem: DataFrame) -> DataFrame:
    ok, ln, pk, sk = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    flag = F.col("l_returnflag")
    slot = pk * 11 % 1440
    return lineitem.select(
        ((ok * 10 + ln) * 100000 + pk).alias("delivery_id"),
        F.when((ok * 10 + ln) % 499 == 0, -ok - 1).otherwise(ok).alias("trip_id"),
        F.when(pk % 97 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("FL"), ok.cast("string"), F.lit("-"), ln.cast("string")))
        .alias("tracking_number"),
        F.when(pk % 89 != 0, F.concat(F.lit("Customer#"), F.lpad(pk.cast("string"), 9, "0"))).alias("customer_name"),
        F.lit(None).cast("string").alias("delivery_address"),
        F.when(pk % 101 == 0, F.lit(0))
        .when(pk % 103 == 0, F.lit(10000))
        .otherwise(F.col("l_quantity"))
        .cast("decimal(10,2)")
        .alias("package_weight_kg"),
        (F.col("l_shipdate") + _minutes(slot)).alias("scheduled_datetime"),
        F.when(
            flag != "N",
            F.col("l_shipdate") + _minutes(slot + (sk * 31 + ln * 97 + pk) % 331 - 120),
        ).alias("delivered_datetime"),
        F.when(flag == "N", "pending").otherwise("delivered").alias("delivery_status"),
        F.when(flag == "A", "signed").when(flag == "R", "").alias("recipient_signature"),
    )


def maintenance_from_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("maintenance_id"),
        F.floor(F.col("user_id") * 2 / 3).cast("bigint").alias("vehicle_id"),
        F.col("ts").cast("date").alias("maintenance_date"),
        F.col("event_type").alias("maintenance_type"),
        F.lit(None).cast("string").alias("description"),
        F.col("value").cast("decimal(10,2)").alias("cost"),
        F.lit(None).cast("date").alias("next_maintenance_date"),
        F.lit(None).cast("string").alias("performed_by"),
    )


def fleet_tables_from_driver_data(spark: SparkSession, sf_dir: str) -> FleetTables:
    """The six operational tables over ``<sf_dir>/<table>.parquet``."""

    def conformed(df: DataFrame, name: str) -> DataFrame:
        return schemas.conform(df, schemas.OLTP[name])

    return FleetTables(
        {
            "vehicles": lambda: conformed(
                vehicles_from_supplier(_read(spark, sf_dir, "supplier")), "vehicles"
            ),
            "drivers": lambda: conformed(
                drivers_from_customer(_read(spark, sf_dir, "customer")), "drivers"
            ),
            "routes": lambda: conformed(
                routes_from_nation(_read(spark, sf_dir, "nation"), _read(spark, sf_dir, "region")),
                "routes",
            ),
            "trips": lambda: conformed(trips_from_orders(_read(spark, sf_dir, "orders")), "trips"),
            "deliveries": lambda: conformed(
                deliveries_from_lineitem(_read(spark, sf_dir, "lineitem")), "deliveries"
            ),
            "maintenance": lambda: conformed(
                maintenance_from_events(_read(spark, sf_dir, "events")), "maintenance"
            ),
        }
    )
