import datetime as dt
import os

from pyspark.sql import functions as F

from parcelflow import schemas
from parcelflow.plans.pipeline import run_pipeline
from parcelflow.sinks.warehouse import Warehouse, stage_overwrite
from parcelflow.sources import fleet_tables_from_driver_data, fleet_tables_from_parquet, write_fleet_tables
from parcelflow.sources.staging import raw_field, stage_raw_json
from parcelflow.sources.tables import FleetTables
from parcelflow.streaming import run_available_now

from inputs import SF_SMALL

AS_OF = dt.date(2001, 9, 1)


def test_parquet_round_trip_keeps_schema(spark, scratch):
    t = fleet_tables_from_driver_data(spark, SF_SMALL)
    write_fleet_tables(t, scratch)
    back = fleet_tables_from_parquet(spark, scratch)
    for name, schema in schemas.OLTP.items():
        assert back.table(name).schema == schema
        assert back.table(name).count() == t.table(name).count()


def test_filters_reach_the_parquet_scan(spark, scratch):
    t = fleet_tables_from_driver_data(spark, SF_SMALL)
    write_fleet_tables(t, scratch)
    back = fleet_tables_from_parquet(spark, scratch)
    plan = back.deliveries.where(F.col("delivered_datetime") >= F.lit(dt.date(2001, 7, 1))).select(
        "delivery_id"
    )._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(delivered_datetime), GreaterThanOrEqual(delivered_datetime" in plan
    assert "ReadSchema: struct<delivery_id:bigint,delivered_datetime:timestamp_ntz>" in plan


def test_stage_raw_json_variant(spark):
    t = fleet_tables_from_driver_data(spark, SF_SMALL)
    staged = stage_raw_json(t.deliveries.limit(5), dt.datetime(2026, 12, 1, 2, 0))
    as_types = lambda st: [(f.name, f.dataType) for f in st.fields]
    assert as_types(staged.schema) == as_types(schemas.STAGING_DAILY_LOAD)
    ids = sorted(r.i for r in staged.select(raw_field("$.delivery_id", "bigint").alias("i")).collect())
    assert ids == sorted(r.delivery_id for r in t.deliveries.limit(5).collect())


def test_stage_overwrite_cuts_lineage(spark, scratch):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    back = stage_overwrite(df, os.path.join(scratch, "stage"))
    assert back.count() == 100
    assert "Scan parquet" in back._jdf.queryExecution().executedPlan().toString()


def test_available_now_matches_batch_load(spark, scratch):
    t = fleet_tables_from_driver_data(spark, SF_SMALL)
    landing = os.path.join(scratch, "landing")
    # Deliveries arrive as two drops of files; trips span both.
    t.deliveries.where(F.col("delivery_id") % 2 == 0).coalesce(1).write.parquet(os.path.join(landing, "drop1"))
    t.deliveries.where(F.col("delivery_id") % 2 == 1).coalesce(1).write.parquet(os.path.join(landing, "drop2"))
    wh_stream = Warehouse(spark, os.path.join(scratch, "wh_stream"))
    results = run_available_now(
        spark, os.path.join(landing, "*"), t, wh_stream, AS_OF, batch_id_base=100, max_files_per_trigger=1
    )
    assert len(results) >= 2
    # A second run finds no new files and loads nothing.
    assert run_available_now(spark, os.path.join(landing, "*"), t, wh_stream, AS_OF, batch_id_base=100) == []
    wh_batch = Warehouse(spark, os.path.join(scratch, "wh_batch"))
    run_pipeline(spark, t, wh_batch, AS_OF, batch_id=1)
    cols = ["delivery_id", "customer_key", "cost_per_delivery"]
    streamed = wh_stream.read("fact_deliveries")
    batched = wh_batch.read("fact_deliveries")
    assert streamed.count() == batched.count() > 0
    # Whichever files a micro-batch has, a touched trip is derived from all its landed deliveries.
    assert streamed.select("delivery_id", "cost_per_delivery").exceptAll(
        batched.select("delivery_id", "cost_per_delivery")
    ).count() == 0
    assert set(cols) <= set(streamed.columns)


def test_fleet_tables_from_frames(spark):
    t = fleet_tables_from_driver_data(spark, SF_SMALL)
    copy = FleetTables.from_frames(**{n: t.table(n) for n in schemas.OLTP})
    assert copy.routes.count() == 25


def test_register_views_for_sql_users(spark):
    from parcelflow.operators import reports

    t = fleet_tables_from_driver_data(spark, SF_SMALL)
    t.register_views()
    sql = spark.sql(
        "SELECT vehicle_type, count(vehicle_id) AS num_vehiculos FROM vehicles GROUP BY vehicle_type"
    )
    assert sorted(sql.collect()) == sorted(reports.vehicles_by_type(t.vehicles).collect())
