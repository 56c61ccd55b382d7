import datetime as dt
import json
import os
from decimal import Decimal as D

from builders import TS, delivery, frame, route, tables, trip, vehicle
from pyspark.sql import functions as F

from parcelflow.operators import expansion, keys, quality
from parcelflow.sinks.warehouse import json_report_sink


def violating_fleet(spark):
    return tables(
        spark,
        vehicles=[vehicle(1, capacity="100")],
        routes=[route(1)],
        trips=[
            trip(1, vid=1, weight="50"),
            trip(2, vid=99, weight="50"),  # orphan vehicle
            trip(3, vid=1, dep=TS(2026, 1, 2), arr=TS(2026, 1, 1), weight="50"),  # arrival < departure
            trip(4, vid=1, weight="150"),  # over capacity
            trip(5, vid=1, arr=None, status="in_progress", weight="50"),  # null arrival is fine
        ],
        deliveries=[delivery(1, tid=1), delivery(2, tid=42), delivery(3, tid=1, tracking="")],
    )


def test_each_check_counts_one(spark):
    report = quality.dq_report(violating_fleet(spark))
    got = {r.check_name: (r.violations, r.ok) for r in report.collect()}
    assert got == {
        "trips_vehicle": (1, False),
        "deliveries_trip": (1, False),
        "time_order": (1, False),
        "weight_capacity": (1, False),
        "tracking_missing": (1, False),
    }
    assert quality.validations_passed(report) is False


def test_summary_report_and_json_sink(spark, scratch):
    t = violating_fleet(spark)
    summary = quality.summary_report(t, quality.dq_report(t), dt.date(2026, 12, 1))
    path = os.path.join(scratch, "summary")
    json_report_sink(summary, path)
    files = [f for f in os.listdir(path) if f.endswith(".json")]
    row = json.loads(open(os.path.join(path, files[0])).read().splitlines()[0])
    assert row["total_records"] == 1 + 0 + 1 + 5 + 3 + 0
    assert row["table_counts"]["trips"] == 5
    assert row["validations_passed"] is False


def test_table_count_and_trip_stats(spark):
    t = violating_fleet(spark)
    counts = {r.table_name: r.row_count for r in quality.table_count(t).collect()}
    assert counts["TOTAL"] == 10 and counts["deliveries"] == 3
    s = quality.deliveries_per_trip_stats(t.deliveries).first()
    assert (s.avg_deliveries_per_trip, s.min_deliveries, s.max_deliveries) == (1.5, 1, 2)


def test_key_unique_and_fk(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (3,), (3,)], "k int")
    r = quality.dq_key_unique(df, ["k"]).first()
    assert (r.duplicate_keys, r.surplus_rows) == (2, 3)
    dim = spark.createDataFrame([(1,), (2,)], "k int")
    assert quality.dq_fk(df, dim, "k").first().violations == 2


def test_symmetric_lookup_normalises_pairs(spark):
    pairs = spark.createDataFrame([("A", "B", D("420.00"))], "a string, b string, d decimal(10,2)")
    legs = spark.createDataFrame([("B", "A"), ("A", "C")], "x string, y string")
    got = sorted((r.x, r.y, r.d) for r in keys.lookup_symmetric_default(legs, "x", "y", pairs, "d", 500).collect())
    assert got == [("A", "C", D("500.00")), ("B", "A", D("420.00"))]


def test_spread_dates_offsets(spark):
    activity = spark.createDataFrame(
        [(1, "Van", 60, TS(2026, 1, 31, 9, 0), TS(2026, 1, 1, 8, 0))],
        "vehicle_id bigint, vehicle_type string, trip_count bigint, last_trip timestamp_ntz, first_trip timestamp_ntz",
    )
    got = [r.scheduled_date for r in expansion.spread_dates(activity).orderBy("seq").collect()]
    assert got == [dt.date(2026, 1, 8), dt.date(2026, 1, 16), dt.date(2026, 1, 23)]


def test_slot_times_with_and_without_arrival(spark):
    t = frame(spark, "trips", [trip(1, dep=TS(2026, 1, 1, 8), arr=TS(2026, 1, 1, 12)),
                               trip(2, dep=TS(2026, 1, 1, 8), arr=None)])
    slots = spark.createDataFrame([(1, 4), (2, 2)], "trip_id bigint, n bigint")
    got = sorted((r.trip_id, r.slot, r.slot_datetime) for r in expansion.slot_times(t, slots).collect())
    assert got == [
        (1, 0, TS(2026, 1, 1, 8, 30)), (1, 1, TS(2026, 1, 1, 9, 30)),
        (1, 2, TS(2026, 1, 1, 10, 30)), (1, 3, TS(2026, 1, 1, 11, 30)),
        (2, 0, TS(2026, 1, 1, 8, 15)), (2, 1, TS(2026, 1, 1, 8, 45)),
    ]


def test_proportional_allocation_with_floor(spark):
    df = spark.createDataFrame(
        [(1, D("1.00"), D("100.00")), (1, D("3.00"), D("100.00")), (1, D("0.00"), D("100.00"))],
        "trip_id bigint, w decimal(10,2), total decimal(10,2)",
    )
    got = sorted(r.allocated for r in expansion.proportional_allocation(df, "trip_id", "w", "total").collect())
    assert got == [D("0.50"), D("23.75"), D("71.25")]


def test_trip_status_relative_to_as_of(spark):
    t = frame(spark, "trips", [trip(1, arr=TS(2026, 11, 30, 23)), trip(2, arr=TS(2026, 12, 1, 1)), trip(3, arr=None)])
    got = {r.trip_id: (r.status, r.arrival_datetime) for r in expansion.trip_status_as_of(t, "2026-12-01").collect()}
    assert got == {1: ("completed", TS(2026, 11, 30, 23)), 2: ("in_progress", None), 3: ("in_progress", None)}


def test_vehicle_activity(spark):
    t = violating_fleet(spark)
    r = quality.vehicle_activity(t.trips, t.vehicles).where(F.col("vehicle_id") == 1).first()
    assert r.trip_count == 4 and r.first_trip == TS(2026, 1, 2)


def test_explode_range_chunks_large_counts(spark):
    df = spark.createDataFrame([(1, 25), (2, 3), (3, 0)], "k bigint, n bigint")
    out = expansion.explode_range(df, "n", "i", first=1, chunk=4)
    got = sorted((r.k, r.i) for r in out.collect())
    assert got == [(1, i) for i in range(1, 26)] + [(2, 1), (2, 2), (2, 3)]
    # chunk rows are redistributed before the big expansion
    assert "Exchange hashpartitioning(xxhash64" in out._jdf.queryExecution().executedPlan().toString()


def test_star_schema_report_flags_duplicates_and_orphans(spark):
    dims = {
        "dim_date": spark.createDataFrame([(20260101,), (20260101,)], "date_key int"),
        "dim_time": spark.createDataFrame([(800,)], "time_key int"),
        "dim_vehicle": spark.createDataFrame([(1,)], "vehicle_key bigint"),
        "dim_driver": spark.createDataFrame([(1,)], "driver_key bigint"),
        "dim_route": spark.createDataFrame([(1,)], "route_key bigint"),
        "dim_customer": spark.createDataFrame([(1,)], "customer_key bigint"),
    }
    fact = spark.createDataFrame(
        [(20260101, 800, 900, 1, 1, 1, 2, 5), (20260101, 800, 800, 1, 1, 1, None, 5)],
        "date_key int, scheduled_time_key int, delivered_time_key int, vehicle_key bigint, "
        "driver_key bigint, route_key bigint, customer_key bigint, delivery_id bigint",
    )
    got = {(r.table_name, r.key_column): r.violations for r in quality.star_schema_report(fact, dims).collect()}
    assert got[("dim_date", "date_key")] == 1
    assert got[("fact_deliveries", "delivered_time_key")] == 1
    assert got[("fact_deliveries", "customer_key")] == 1
    assert got[("fact_deliveries", "delivery_id")] == 1
    assert sum(got.values()) == 4 and len(got) == 14
