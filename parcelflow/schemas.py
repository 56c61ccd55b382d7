"""Explicit schemas of the operational tables and the star schema.

Nothing is inferred: sources read with these ``StructType``s and every
warehouse write goes through :func:`conform`, so types never drift between
batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

LONG = T.LongType()
INT = T.IntegerType()
STR = T.StringType()
DATE = T.DateType()
TS = T.TimestampNTZType()
BOOL = T.BooleanType()
DBL = T.DoubleType()


def dec(precision: int, scale: int) -> T.DecimalType:
    return T.DecimalType(precision, scale)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# ---------------------------------------------------------------------------
# Operational (OLTP) tables
# ---------------------------------------------------------------------------

VEHICLES = _schema(
    ("vehicle_id", LONG),
    ("license_plate", STR),
    ("vehicle_type", STR),
    ("capacity_kg", dec(10, 2)),
    ("fuel_type", STR),
    ("acquisition_date", DATE),
    ("status", STR),
)

DRIVERS = _schema(
    ("driver_id", LONG),
    ("employee_code", STR),
    ("first_name", STR),
    ("last_name", STR),
    ("license_number", STR),
    ("license_expiry", DATE),
    ("phone", STR),
    ("hire_date", DATE),
    ("status", STR),
)

ROUTES = _schema(
    ("route_id", LONG),
    ("route_code", STR),
    ("origin_city", STR),
    ("destination_city", STR),
    ("distance_km", dec(10, 2)),
    ("estimated_duration_hours", dec(5, 2)),
    ("toll_cost", dec(10, 2)),
)

TRIPS = _schema(
    ("trip_id", LONG),
    ("vehicle_id", LONG),
    ("driver_id", LONG),
    ("route_id", LONG),
    ("departure_datetime", TS),
    ("arrival_datetime", TS),
    ("fuel_consumed_liters", dec(10, 2)),
    ("total_weight_kg", dec(10, 2)),
    ("status", STR),
)

DELIVERIES = _schema(
    ("delivery_id", LONG),
    ("trip_id", LONG),
    ("tracking_number", STR),
    ("customer_name", STR),
    ("delivery_address", STR),
    ("package_weight_kg", dec(10, 2)),
    ("scheduled_datetime", TS),
    ("delivered_datetime", TS),
    ("delivery_status", STR),
    ("recipient_signature", STR),
)

MAINTENANCE = _schema(
    ("maintenance_id", LONG),
    ("vehicle_id", LONG),
    ("maintenance_date", DATE),
    ("maintenance_type", STR),
    ("description", STR),
    ("cost", dec(10, 2)),
    ("next_maintenance_date", DATE),
    ("performed_by", STR),
)

OLTP = {
    "vehicles": VEHICLES,
    "drivers": DRIVERS,
    "routes": ROUTES,
    "trips": TRIPS,
    "deliveries": DELIVERIES,
    "maintenance": MAINTENANCE,
}

# ---------------------------------------------------------------------------
# Warehouse (star schema)
# ---------------------------------------------------------------------------

DIM_DATE = _schema(
    ("date_key", INT),
    ("full_date", DATE),
    ("day_of_week", INT),
    ("day_name", STR),
    ("day_of_month", INT),
    ("day_of_year", INT),
    ("week_of_year", INT),
    ("month_num", INT),
    ("month_name", STR),
    ("quarter", INT),
    ("year", INT),
    ("is_weekend", BOOL),
    ("is_holiday", BOOL),
    ("holiday_name", STR),
    ("fiscal_quarter", INT),
    ("fiscal_year", INT),
)

DIM_TIME = _schema(
    ("time_key", INT),
    ("hour", INT),
    ("minute", INT),
    ("second", INT),
    ("time_of_day", STR),
    ("hour_24", STR),
    ("hour_12", STR),
    ("am_pm", STR),
    ("is_business_hour", BOOL),
    ("shift", STR),
)

DIM_VEHICLE = _schema(
    ("vehicle_key", LONG),
    ("vehicle_id", LONG),
    ("license_plate", STR),
    ("vehicle_type", STR),
    ("capacity_kg", dec(10, 2)),
    ("fuel_type", STR),
    ("acquisition_date", DATE),
    ("age_months", INT),
    ("status", STR),
    ("last_maintenance_date", DATE),
    ("valid_from", DATE),
    ("valid_to", DATE),
    ("is_current", BOOL),
)

DIM_DRIVER = _schema(
    ("driver_key", LONG),
    ("driver_id", LONG),
    ("employee_code", STR),
    ("full_name", STR),
    ("license_number", STR),
    ("license_expiry", DATE),
    ("phone", STR),
    ("hire_date", DATE),
    ("experience_months", INT),
    ("status", STR),
    ("performance_category", STR),
    ("valid_from", DATE),
    ("valid_to", DATE),
    ("is_current", BOOL),
)

DIM_ROUTE = _schema(
    ("route_key", LONG),
    ("route_id", LONG),
    ("route_code", STR),
    ("origin_city", STR),
    ("destination_city", STR),
    ("distance_km", dec(10, 2)),
    ("estimated_duration_hours", dec(5, 2)),
    ("toll_cost", dec(10, 2)),
    ("difficulty_level", STR),
    ("route_type", STR),
)

DIM_CUSTOMER = _schema(
    ("customer_key", LONG),
    ("customer_id", LONG),
    ("customer_name", STR),
    ("customer_type", STR),
    ("city", STR),
    ("first_delivery_date", DATE),
    ("total_deliveries", INT),
    ("customer_category", STR),
)

# Minutes keep two decimals and rates are widened (DECIMAL(5,2) overflows
# above 999.99), see SURVEY trap T11.
FACT_DELIVERIES = _schema(
    ("date_key", INT),
    ("scheduled_time_key", INT),
    ("delivered_time_key", INT),
    ("vehicle_key", LONG),
    ("driver_key", LONG),
    ("route_key", LONG),
    ("customer_key", LONG),
    ("delivery_id", LONG),
    ("trip_id", LONG),
    ("tracking_number", STR),
    ("package_weight_kg", dec(10, 2)),
    ("distance_km", dec(10, 2)),
    ("fuel_consumed_liters", dec(10, 2)),
    ("delivery_time_minutes", dec(12, 2)),
    ("delay_minutes", dec(12, 2)),
    ("deliveries_per_hour", dec(10, 2)),
    ("fuel_efficiency_km_per_liter", dec(10, 2)),
    ("cost_per_delivery", dec(10, 2)),
    ("revenue_per_delivery", dec(10, 2)),
    ("is_on_time", BOOL),
    ("is_damaged", BOOL),
    ("has_signature", BOOL),
    ("delivery_status", STR),
    ("etl_batch_id", LONG),
    ("etl_timestamp", TS),
)

DAILY_TOTALS = _schema(
    ("date_key", INT),
    ("num_entregas", LONG),
    ("total_revenue", dec(18, 2)),
    ("avg_delivery_time", dec(18, 2)),
    ("on_time_rate", dec(18, 2)),
    ("etl_batch_id", LONG),
)

# What became of every delivery a batch has looked at: the newest row of an id counts. A loaded
# delivery has the date_key of its fact row, a rejected one the reason.
LOAD_STATE = _schema(
    ("bucket", INT),
    ("delivery_id", LONG),
    ("trip_id", LONG),
    ("fingerprint", LONG),
    ("date_key", INT),
    ("reason", STR),
    ("snapshot", LONG),
)

# Sums behind daily_totals; batches add what they load and take off what they replace.
TOTALS_STATE = _schema(
    ("date_key", INT),
    ("n_rows", LONG),
    ("revenue", dec(38, 2)),
    ("minutes", dec(38, 2)),
    ("n_minutes", LONG),
    ("n_on_time", LONG),
    ("etl_batch_id", LONG),
)

STAGING_DAILY_LOAD = T.StructType(
    [
        T.StructField("raw_data", T.VariantType(), True),
        T.StructField("load_timestamp", TS, True),
    ]
)

BATCH_METRICS = _schema(
    ("etl_batch_id", LONG),
    ("as_of", DATE),
    ("records_extracted", LONG),
    ("records_transformed", LONG),
    ("records_loaded", LONG),
    ("errors", LONG),
)

# Every version of an entity, numbered from 1; kept beside the insert-only dimensions when a batch is asked to.
VEHICLE_HISTORY = _schema(
    ("vehicle_id", LONG),
    ("version", INT),
    ("license_plate", STR),
    ("vehicle_type", STR),
    ("capacity_kg", dec(10, 2)),
    ("fuel_type", STR),
    ("acquisition_date", DATE),
    ("status", STR),
    ("valid_from", DATE),
    ("valid_to", DATE),
    ("is_current", BOOL),
)

DRIVER_HISTORY = _schema(
    ("driver_id", LONG),
    ("version", INT),
    ("employee_code", STR),
    ("first_name", STR),
    ("last_name", STR),
    ("license_number", STR),
    ("license_expiry", DATE),
    ("phone", STR),
    ("hire_date", DATE),
    ("status", STR),
    ("valid_from", DATE),
    ("valid_to", DATE),
    ("is_current", BOOL),
)

WAREHOUSE = {
    "dim_date": DIM_DATE,
    "dim_time": DIM_TIME,
    "dim_vehicle": DIM_VEHICLE,
    "dim_driver": DIM_DRIVER,
    "dim_route": DIM_ROUTE,
    "vehicle_history": VEHICLE_HISTORY,
    "driver_history": DRIVER_HISTORY,
    "dim_customer": DIM_CUSTOMER,
    "fact_deliveries": FACT_DELIVERIES,
    "load_state": LOAD_STATE,
    "totals_state": TOTALS_STATE,
    "daily_totals": DAILY_TOTALS,
    "staging_daily_load": STAGING_DAILY_LOAD,
    "etl_batch_metrics": BATCH_METRICS,
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: cast present columns, null-fill absent ones.

    Extra columns are dropped. This is the warehouse's DDL in DataFrame form.
    Built as one ``selectExpr`` so a wide table costs one planner call.
    """
    present = set(df.columns)
    exprs = []
    for field in schema.fields:
        dtype = field.dataType.simpleString()
        source = f"`{field.name}`" if field.name in present else "NULL"
        exprs.append(f"CAST({source} AS {dtype}) AS `{field.name}`")
    return df.selectExpr(*exprs)
