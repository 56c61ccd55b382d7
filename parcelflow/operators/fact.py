"""Fact rows, daily totals and the two reporting views of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import calendar as cal
from parcelflow.operators.scans import filter_not_equal

# Fixed value: the fact's 23 loaded columns, in order.
FACT_COLUMNS = [
    "date_key", "scheduled_time_key", "delivered_time_key",
    "vehicle_key", "driver_key", "route_key", "customer_key",
    "delivery_id", "trip_id", "tracking_number",
    "package_weight_kg", "distance_km", "fuel_consumed_liters",
    "delivery_time_minutes", "delay_minutes",
    "deliveries_per_hour", "fuel_efficiency_km_per_liter",
    "cost_per_delivery", "revenue_per_delivery",
    "is_on_time", "has_signature", "delivery_status", "etl_batch_id",
]

# Fixed value: customer type hidden from the sales view.
HIDDEN_CUSTOMER_TYPE = "Gobierno"


def fact_rows(transformed: DataFrame, maps: dict[str, DataFrame], batch_id: int) -> DataFrame:
    """Resolve surrogate keys and project the fact columns.

    Each lookup is an inner join (lookup + drop of unresolved rows) on a map
    with one row per natural key. The planner and AQE choose how to join.
    """
    df = (
        transformed.join(maps["vehicle"], "vehicle_id")
        .join(maps["driver"], "driver_id")
        .join(maps["route"], "route_id")
        .join(maps["customer"], "customer_name")
    )
    df = df.withColumns(
        {
            "date_key": cal.date_key("scheduled_datetime"),
            "scheduled_time_key": cal.time_key("scheduled_datetime"),
            "delivered_time_key": cal.time_key("delivered_datetime"),
            "etl_batch_id": F.lit(int(batch_id)).cast("bigint"),
        }
    )
    return df.select(*FACT_COLUMNS)


def daily_sums(fact: DataFrame) -> DataFrame:
    """Per date, the sums that the totals are made of (``schemas.TOTALS_STATE``)."""
    zero = F.lit(0).cast("decimal(38,2)")
    return fact.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum("revenue_per_delivery").cast("decimal(38,2)"), zero).alias("revenue"),
        F.coalesce(F.sum("delivery_time_minutes").cast("decimal(38,2)"), zero).alias("minutes"),
        F.count("delivery_time_minutes").alias("n_minutes"),
        F.count_if("is_on_time").alias("n_on_time"),
        F.max("etl_batch_id").alias("etl_batch_id"),
    )


def changed_sums(sums: DataFrame, loaded: DataFrame, replaced: DataFrame, batch_id: int) -> DataFrame:
    """Sums per date after a batch loaded some fact rows in place of others; dates without rows go."""
    names = ["n_rows", "revenue", "minutes", "n_minutes", "n_on_time"]
    batch = F.lit(int(batch_id)).cast("bigint").alias("etl_batch_id")
    plus = daily_sums(loaded).select("date_key", *names, batch)
    minus = daily_sums(replaced).select("date_key", *((-F.col(c)).alias(c) for c in names), batch)
    parts = sums.select("date_key", *names, "etl_batch_id").unionByName(plus).unionByName(minus)
    return (
        parts.groupBy("date_key")
        .agg(*(F.sum(c).alias(c) for c in names), F.max("etl_batch_id").alias("etl_batch_id"))
        .where(F.col("n_rows") > 0)
    )


def totals_of(sums: DataFrame) -> DataFrame:
    """``daily_totals`` rows from the sums.

    Means are taken as exact DECIMAL sum / count and rounded half up, so a
    large day cannot pick up a double-rounding error.
    """
    whole = lambda c: F.col(c).cast("decimal(20,0)")
    minutes = F.col("minutes").cast("decimal(22,2)") / F.nullif(whole("n_minutes"), F.lit(0).cast("decimal(20,0)"))
    return sums.select(
        "date_key",
        F.col("n_rows").alias("num_entregas"),
        F.col("revenue").cast("decimal(18,2)").alias("total_revenue"),
        F.round(minutes, 2).cast("decimal(18,2)").alias("avg_delivery_time"),
        F.round(whole("n_on_time") / whole("n_rows"), 2).cast("decimal(18,2)").alias("on_time_rate"),
        "etl_batch_id",
    )


def daily_totals(fact: DataFrame) -> DataFrame:
    """Per date: rows, revenue, mean delivery minutes, on-time rate and the last batch that touched it."""
    return totals_of(daily_sums(fact))


def batch_count(fact: DataFrame, batch_id: int) -> DataFrame:
    """One-row count of the fact rows of one batch."""
    return fact.where(F.col("etl_batch_id") == int(batch_id)).agg(F.count(F.lit(1)).alias("total_records"))


def sales_view(fact: DataFrame, dim_date: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Sales view: six columns; rows of the hidden customer type (and NULL types) excluded."""
    shown = filter_not_equal(dim_customer, "customer_type", HIDDEN_CUSTOMER_TYPE)
    return (
        fact.join(dim_date.select("date_key", "full_date"), "date_key")
        .join(shown.select("customer_key", "customer_name", "customer_type"), "customer_key")
        .select(
            "full_date", "customer_name", "customer_type", "package_weight_kg", "delivery_status",
            "revenue_per_delivery",
        )
    )


def operations_view(
    fact: DataFrame,
    dim_date: DataFrame,
    dim_time: DataFrame,
    dim_vehicle: DataFrame,
    dim_driver: DataFrame,
    dim_route: DataFrame,
    dim_customer: DataFrame,
) -> DataFrame:
    """Operations view: the fact joined to all six dimensions (ten columns)."""
    return (
        fact.join(dim_date.select("date_key", "full_date"), "date_key")
        .join(
            dim_time.select(F.col("time_key").alias("scheduled_time_key"), F.col("hour_24").alias("hora")),
            "scheduled_time_key",
        )
        .join(dim_vehicle.select("vehicle_key", "license_plate"), "vehicle_key")
        .join(dim_driver.select("driver_key", F.col("full_name").alias("conductor")), "driver_key")
        .join(dim_route.select("route_key", "route_code"), "route_key")
        .join(dim_customer.select("customer_key", "customer_name"), "customer_key")
        .select(
            "full_date", "hora", "license_plate", "conductor", "route_code", "customer_name",
            "delivery_time_minutes", "delay_minutes", "is_on_time", "fuel_consumed_liters",
        )
    )
