"""Plan shape: pushdown, pruning, broadcast by size, no single-task work on data."""

import datetime as dt

from parcelflow.operators import etl, reports
from parcelflow.plans import catalog
from parcelflow.sources import fleet_tables_from_parquet, write_fleet_tables
from parcelflow.sources.driver_tables import fleet_tables_from_driver_data

from inputs import SF_SMALL

AS_OF = dt.date(2001, 9, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def fleet(spark, scratch):
    write_fleet_tables(fleet_tables_from_driver_data(spark, SF_SMALL), scratch)
    return fleet_tables_from_parquet(spark, scratch)


def test_report_scan_prunes_and_pushes(spark, scratch):
    t = fleet(spark, scratch)
    plan = plan_of(reports.deliveries_by_city(t.deliveries, t.trips, t.routes, AS_OF))
    assert "GreaterThanOrEqual(delivered_datetime,2001-07-03T00:00)" in plan
    assert "ReadSchema: struct<delivery_id:bigint,trip_id:bigint,delivered_datetime:timestamp_ntz>" in plan
    # deliveries are reduced per trip before the join on trip_id
    assert plan.index("HashAggregate") < plan.index("Scan parquet")


def test_extract_broadcasts_small_dimensions(spark, scratch):
    t = fleet(spark, scratch)
    ext = etl.extract_daily(t.deliveries, t.trips, t.routes, t.vehicles, t.drivers, AS_OF)
    ext.count()
    final = ext._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in final
    assert "CartesianProduct" not in final and "BroadcastNestedLoopJoin" not in final


def test_no_registered_query_uses_a_cross_product(spark):
    for name, fn in catalog.spark_queries().items():
        if name in {"fact_after_two_batches", "totals_after_two_batches", "fact_after_dependency_changes", "rerun_changes_nothing"}:
            continue  # these load a warehouse while planning and return a scan of it
        logical = fn(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join Cross" not in logical, name


def test_windows_over_data_are_partitioned(spark):
    # Only trip_trend (one row per month) and the key offsets (one row per
    # slice) use an unpartitioned window; data-sized windows have keys.
    for name in ("driver_ranking", "group_size_broadcast", "transform_all"):
        plan = catalog.spark_queries()[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        for line in plan.splitlines():
            if "Window [" in line:
                assert "windowspecdefinition(" in line and ", [" not in line.split("windowspecdefinition(")[1][:2]


def test_bucketed_tables_join_without_shuffle(spark):
    from parcelflow.sources import fleet_tables_from_catalog, write_fleet_catalog

    write_fleet_catalog(spark, fleet_tables_from_driver_data(spark, SF_SMALL), "fleet_bucketed", buckets=4)
    t = fleet_tables_from_catalog(spark, "fleet_bucketed")
    # Broadcast off: at scale trips are far too big to broadcast.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        q4 = reports.deliveries_by_city(t.deliveries, t.trips, t.routes, AS_OF)
        q4.collect()
        plan = plan_of(q4)
        assert "SortMergeJoin" in plan
        assert "hashpartitioning(trip_id" not in plan.lower()
        joined = t.deliveries.join(t.trips, "trip_id", "left")  # some deliveries have no trip
        assert "hashpartitioning(trip_id" not in plan_of(joined).lower()
        assert joined.count() == t.deliveries.count()
        # the pipeline's extract + transform, with per-trip sizes counted on the buckets
        batch = etl.transform_all(
            etl.extract_daily(t.deliveries, t.trips, t.routes, t.vehicles, t.drivers, AS_OF, with_trip_sizes=True),
            AS_OF,
        )
        batch.count()
        assert "hashpartitioning(trip_id" not in plan_of(batch).lower()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def _rows_per_task(df):
    from pyspark.sql import functions as F

    return [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]


def test_hot_trip_is_spread_over_tasks(spark):
    """A trip with a third of all deliveries: no task of the library's own joins gets more than a small share."""
    from pyspark.sql import functions as F

    from parcelflow.operators import etl as etl_ops
    from parcelflow.operators import expansion

    n = 60_000
    deliveries = spark.range(n).select(
        F.col("id").alias("delivery_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("trip_id"),
        (F.col("id") % 50 + 1).cast("decimal(10,2)").alias("package_weight_kg"),
        F.lit(100).cast("decimal(10,2)").alias("total_weight_kg"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        sized = etl_ops.add_group_size(deliveries, "trip_id", "n")
        shared = expansion.proportional_allocation(deliveries, "trip_id", "package_weight_kg", "total_weight_kg")
        for out in (sized, shared):
            tasks = _rows_per_task(out)
            assert sum(tasks) == n and max(tasks) < n / 5
        assert sized.where("trip_id = 0").select("n").distinct().collect()[0].n == n // 3
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_bucketed_landing_writes_one_file_per_bucket(spark):
    import glob
    import os

    from parcelflow import schemas
    from parcelflow.sources import fleet_tables_from_catalog, write_fleet_catalog

    write_fleet_catalog(spark, fleet_tables_from_driver_data(spark, SF_SMALL), "fleet_files", buckets=3)
    t = fleet_tables_from_catalog(spark, "fleet_files")
    for name, schema in schemas.OLTP.items():
        assert [(f.name, f.dataType) for f in t.table(name).schema.fields] == [
            (f.name, f.dataType) for f in schema.fields
        ]
    location = spark.sql("DESCRIBE TABLE EXTENDED fleet_files.deliveries").where("col_name = 'Location'").first()
    folder = location.data_type.replace("file:", "")
    files = [f for f in glob.glob(os.path.join(folder, "*.parquet"))]
    assert len(files) == 3
