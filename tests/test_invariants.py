"""Invariants of SURVEY §5 (d) on the sf0.001 tables."""

import datetime as dt

from pyspark.sql import functions as F

from parcelflow.operators import reports
from parcelflow.operators.reports import PIVOT_DAYS
from parcelflow.plans.first_load import FirstLoad
from parcelflow.sources.driver_tables import fleet_tables_from_driver_data

from inputs import SF_SMALL

AS_OF = dt.date(2001, 9, 1)


def test_pivot_cells_sum_to_delivered_rows(spark):
    t = fleet_tables_from_driver_data(spark, SF_SMALL)
    pivot = reports.hour_weekday_pivot(t.deliveries)
    total = pivot.agg(F.sum(sum(F.col(name) for name, _ in PIVOT_DAYS)).alias("n")).first().n
    delivered = t.deliveries.where(F.col("delivery_status") == "delivered").count()
    assert total == delivered > 0


def test_totals_add_up_to_the_fact_and_dimensions_are_unique(spark):
    load = FirstLoad(fleet_tables_from_driver_data(spark, SF_SMALL), AS_OF)
    fact_rows = load.fact().count()
    assert load.totals().agg(F.sum("num_entregas")).first()[0] == fact_rows > 0
    for dim, key in [(load.dim_vehicle(), "vehicle_key"), (load.dim_driver(), "driver_key"),
                     (load.dim_route(), "route_key"), (load.dim_customer(), "customer_key"),
                     (load.dim_date(), "date_key"), (load.dim_time(), "time_key")]:
        assert dim.count() == dim.select(key).distinct().count()
