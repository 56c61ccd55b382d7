"""Incremental loads: what changed, what is rejected, one commit, versions of entities."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from parcelflow import schemas
from parcelflow.operators import etl, fact, history, keys
from parcelflow.plans import load_state
from parcelflow.plans.pipeline import run_pipeline
from parcelflow.sinks.snapshots import CommitConflict
from parcelflow.sinks.warehouse import Warehouse

from builders import TS, delivery, driver, frame, route, tables, trip, vehicle

AS_OF = dt.date(2026, 12, 1)


def fleet(spark, deliveries=None, routes=None, drivers=None, vehicles=None, trips=None):
    return tables(
        spark,
        vehicles=vehicles or [vehicle(1), vehicle(2)],
        drivers=drivers or [driver(1), driver(2)],
        routes=routes or [route(1), route(2, destination="Pasto", toll_cost=D("90000.00"))],
        trips=trips or [trip(1), trip(2, rid=2), trip(3, vid=2, did=2)],
        deliveries=deliveries or [
            delivery(11, tid=1, customer="Ana"), delivery(12, tid=1, customer="Beto"), delivery(21, tid=2, customer="Ana"),
            delivery(31, tid=3, customer="Caro", sched=TS(2026, 11, 3, 9, 0), delivered=TS(2026, 11, 3, 9, 5)),
        ],
    )


def state_of(wh):
    rows = load_state.newest_state(wh.read("load_state")).collect()
    return {r.delivery_id: r.reason or r.date_key for r in rows}


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rejected_rows_wait_for_what_they_lack(spark, scratch):
    lacking = [
        delivery(11, tid=1), delivery(12, tid=1, weight="0.00"), delivery(13, tid=1, customer=None), delivery(14, tid=9),
        delivery(21, tid=2), delivery(31, tid=3), delivery(41, tid=4), delivery(51, tid=None),
    ]
    trips = [trip(1), trip(2, rid=7), trip(3, vid=8), trip(4, did=6)]
    wh = Warehouse(spark, scratch)
    first = run_pipeline(spark, fleet(spark, lacking, trips=trips), wh, AS_OF, batch_id=1)
    assert first.records_loaded == 1
    expected = {11: 20261102, 12: "filtered", 13: "no_customer", 14: "no_trip", 21: "no_route", 31: "no_vehicle",
                41: "no_driver", 51: "no_trip"}
    assert state_of(wh) == expected
    assert {r.delivery_id: r.reason for r in load_state.rejected_deliveries(wh).collect()} == {
        k: v for k, v in expected.items() if k != 11
    }
    before = {name: wh.segments(name) for name in schemas.WAREHOUSE if name != "etl_batch_metrics"}
    again = run_pipeline(spark, fleet(spark, lacking, trips=trips), wh, AS_OF, batch_id=2)
    assert (again.records_extracted, again.records_loaded) == (0, 0)
    assert {name: wh.segments(name) for name in before} == before  # no file of any other table is touched

    there = fleet(
        spark, lacking, trips=[*trips, trip(9)], routes=[route(1), route(7)], vehicles=[vehicle(1), vehicle(8)],
        drivers=[driver(1), driver(6)],
    )
    late = run_pipeline(spark, there, wh, AS_OF, batch_id=3)
    assert late.records_loaded == 4 and late.records_extracted == 4  # trip 1 has not changed
    assert state_of(wh) == {**expected, 14: 20261102, 21: 20261102, 31: 20261102, 41: 20261102}
    # a delivery that stops passing the filters leaves the fact
    worse = [*lacking[1:], delivery(11, tid=1, weight="99999.00")]
    run_pipeline(spark, fleet(spark, worse, trips=trips), wh, AS_OF, batch_id=4)
    assert state_of(wh)[11] == "filtered" and 11 not in {r.delivery_id for r in wh.read("fact_deliveries").collect()}


def test_a_changed_toll_derives_its_trips_anew_and_no_others(spark, scratch):
    wh = Warehouse(spark, scratch)
    run_pipeline(spark, fleet(spark), wh, AS_OF, batch_id=1)
    dearer = fleet(spark, routes=[route(1, toll_cost=D("100000.00")), route(2, destination="Pasto", toll_cost=D("90000.00"))])
    second = run_pipeline(spark, dearer, wh, AS_OF, batch_id=2)
    assert second.records_loaded == 3  # trips 1 and 3 use route 1
    assert {r.delivery_id: r.etl_batch_id for r in wh.read("fact_deliveries").collect()} == {11: 2, 12: 2, 21: 1, 31: 2}
    once = Warehouse(spark, scratch + "/once")
    run_pipeline(spark, dearer, once, AS_OF, batch_id=2)
    columns = [c for c in fact.FACT_COLUMNS if c not in ("customer_key", "etl_batch_id")] + ["etl_timestamp"]
    assert same(wh.read("fact_deliveries").select(*columns), once.read("fact_deliveries").select(*columns))
    totals = ["date_key", "num_entregas", "total_revenue", "avg_delivery_time", "on_time_rate"]
    recomputed = fact.daily_totals(wh.read("fact_deliveries"))
    assert same(wh.read("daily_totals").select(*totals), recomputed.select(*totals))
    # names and other columns that no fact depends on change nothing
    renamed = fleet(spark, routes=[route(1, toll_cost=D("100000.00"), route_code="X"),
                                   route(2, destination="Pasto", toll_cost=D("90000.00"))])
    assert run_pipeline(spark, renamed, wh, AS_OF, batch_id=3).records_extracted == 0


def test_a_failure_between_any_two_writes_leaves_the_old_snapshot(spark, scratch, monkeypatch):
    wh = Warehouse(spark, scratch)
    run_pipeline(spark, fleet(spark), wh, AS_OF, batch_id=1)
    tables_ = [n for n in schemas.WAREHOUSE if n != "etl_batch_metrics"]
    before = {n: wh.segments(n) for n in tables_}
    rows = sorted(map(str, wh.read("fact_deliveries").collect()))
    more = fleet(spark, [delivery(11, tid=1, customer="Nueva", weight="20.00"), delivery(12, tid=2, customer="Otra")])
    write, calls = Warehouse._write, []

    def counted(self, name, *args):
        calls.append(name)
        if len(calls) == fail_at and name != "etl_batch_metrics":
            raise RuntimeError(f"executor lost while writing {name}")
        return write(self, name, *args)

    monkeypatch.setattr(Warehouse, "_write", counted)
    for fail_at in (1, 7, 10):
        calls.clear()
        with pytest.raises(RuntimeError):
            run_pipeline(spark, more, wh, AS_OF, batch_id=2)
        reader = Warehouse(spark, scratch)
        assert {n: reader.segments(n) for n in tables_} == before
        assert sorted(map(str, reader.read("fact_deliveries").collect())) == rows
    monkeypatch.undo()
    assert run_pipeline(spark, more, wh, AS_OF, batch_id=2).records_loaded == 2
    assert state_of(wh)[12] == 20261102 and wh.read("dim_customer").count() == 5
    assert wh.read("etl_batch_metrics").where("errors = 1").count() == 3


def test_snapshots_readers_writers_and_vacuum(spark, scratch):
    wh = Warehouse(spark, scratch, state_buckets=4)
    row = lambda day, n: spark.createDataFrame([(day, n, D("1.00"), None, None, 1)], schemas.DAILY_TOTALS)
    with wh.transaction() as number:
        wh.replace("daily_totals", row(20260101, 1))
        assert wh.read("daily_totals").count() == 1 and Warehouse(spark, scratch).read("daily_totals").count() == 0
    assert wh.snapshot() == number == 1
    old = wh.read("daily_totals")
    wh.replace("daily_totals", row(20260102, 2))
    assert [r.num_entregas for r in old.collect()] == [1] == [r.num_entregas for r in wh.read("daily_totals", 1).collect()]
    assert Warehouse(spark, scratch, state_buckets=9).state_buckets == 4  # kept from when it was made
    other = Warehouse(spark, scratch)
    with pytest.raises(CommitConflict), wh.transaction():
        wh.replace("daily_totals", row(20260103, 3))
        other.append("daily_totals", row(20260104, 4))
    assert sorted(r.num_entregas for r in wh.read("daily_totals").collect()) == [2, 4]
    assert wh.vacuum(keep=1) == 2  # the first version and the one whose commit lost
    assert sorted(r.num_entregas for r in wh.read("daily_totals").collect()) == [2, 4]
    wh.append("daily_totals", row(1, 1).where("false"))
    assert wh.snapshot() == 3  # nothing to commit


def test_partitions_are_replaced_and_dropped(spark, scratch):
    wh = Warehouse(spark, scratch)
    rows = lambda *x: spark.createDataFrame([(d, i) for d, i in x], "date_key int, delivery_id long")
    wh.append("fact_deliveries", rows((1, 10), (2, 20), (3, 30)), ["date_key"])
    wh.replace_partitions("fact_deliveries", rows((2, 21), (2, 22), (4, 40)), ["date_key"])
    wh.drop_partitions("fact_deliveries", "date_key", [3])
    assert sorted((r.date_key, r.delivery_id) for r in wh.read("fact_deliveries").collect()) == [(1, 10), (2, 21), (2, 22), (4, 40)]
    assert wh.partition_values("fact_deliveries", "date_key") == {"1", "2", "4"}


def test_a_batch_reads_only_its_partitions(spark, scratch):
    wh = Warehouse(spark, scratch, state_buckets=8)
    run_pipeline(spark, fleet(spark), wh, AS_OF, batch_id=1)
    now = spark.createDataFrame([(11, 1, 5, None)], "delivery_id long, trip_id long, fingerprint long, reason string")
    known = load_state.known_state(wh, now)
    assert [r.delivery_id for r in known.collect()] == [11]
    plan = known._jdf.queryExecution().executedPlan().toString()
    bucket = now.select(load_state.bucket_of(wh)).first()[0]
    assert "PartitionFilters: [isnotnull(bucket" in plan and f"(bucket#" in plan and f"= {bucket})" in plan
    assert "GreaterThanOrEqual(delivery_id,11), LessThanOrEqual(delivery_id,11)" in plan
    one = wh.read("fact_deliveries").where(F.col("date_key").isin([20261103]))
    assert "PartitionFilters: [isnotnull(date_key" in one._jdf.queryExecution().executedPlan().toString()
    assert len(one.inputFiles()) > 0 and one.count() == 1


def test_state_buckets_are_rewritten_after_many_batches(spark, scratch, monkeypatch):
    monkeypatch.setattr(load_state, "MOST_VERSIONS", 2)
    wh = Warehouse(spark, scratch, state_buckets=1)
    touched = "delivery_id long, trip_id long, fingerprint long, reason string, changed boolean, old_date_key int"
    loaded = "delivery_id long, date_key int"
    for k in range(1, 5):
        rows = spark.createDataFrame([(7, 1, k, None, True, None), (8 + k, 1, k, "no_trip", True, None)], touched)
        with wh.transaction() as number:
            load_state.append_state(wh, rows, spark.createDataFrame([(7, 20260100 + k)], loaded), number)
        assert len(wh.segments("load_state")) <= 2
    newest = load_state.newest_state(wh.read("load_state")).orderBy("delivery_id").collect()
    assert [(r.delivery_id, r.fingerprint, r.date_key, r.reason) for r in newest] == [
        (7, 4, 20260104, None), (9, 1, None, "no_trip"), (10, 2, None, "no_trip"), (11, 3, None, "no_trip"), (12, 4, None, "no_trip"),
    ]


def test_hot_trips_are_not_shuffled(spark):
    n = 48_000
    d = spark.range(n).select(
        F.col("id").alias("delivery_id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("trip_id")
    ).repartition(32)
    trips = spark.range(n).select(F.col("id").alias("trip_id"), (F.col("id") % 10).alias("route_id"))
    counts = d.groupBy("trip_id").agg(F.count(F.lit(1)).alias("n"))
    hot = keys.heavy_hitters(counts, "trip_id")
    assert hot == [0]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.shuffle.partitions": "32"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = keys.join_heavy_hitters(d, trips, "trip_id", hot)
        tasks = [r.n for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(tasks) == n and max(tasks) < n / 8
        assert out.where("trip_id = 0").count() == n // 3
        assert same(out, keys.join_heavy_hitters(d, trips, "trip_id", []))
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_hot_trip_through_extract_and_batch(spark, scratch):
    hot = [delivery(i, tid=1, customer=f"C{i % 7}") for i in range(1, 61)]
    cold = [delivery(1000 + i, tid=2 + i % 50, customer=f"C{i % 7}") for i in range(120)]
    t = fleet(spark, hot + cold, trips=[trip(i) for i in range(1, 52)])
    plain = etl.extract_daily(t.deliveries, t.trips, t.routes, t.vehicles, t.drivers, AS_OF, with_trip_sizes=True)
    split = etl.extract_daily(
        t.deliveries, t.trips, t.routes, t.vehicles, t.drivers, AS_OF, with_trip_sizes=True, hot_trips=[1]
    )
    assert plain.count() == 180 and same(plain, split)
    wh = Warehouse(spark, scratch)
    assert run_pipeline(spark, t, wh, AS_OF, batch_id=1).records_loaded == 180


def test_lookup_filter_passes_all_that_match(spark):
    names = spark.createDataFrame([(f"n{i}",) for i in range(0, 500, 5)] + [(None,)], "name string")
    dim = spark.createDataFrame([(f"n{i}", i) for i in range(20_000)] + [(None, -1)], "name string, k int")
    got = keys.probably_among(dim, "name", names, 100)
    assert got.columns == dim.columns
    found = {r.k for r in got.collect()}
    assert set(range(0, 500, 5)) <= found and len(found) < 2000 and -1 not in found
    assert keys.probably_among(dim, "name", names.where("false"), 0).count() == 0


def test_versions_close_and_open(spark):
    schema, key = schemas.VEHICLE_HISTORY, "vehicle_id"
    seen = lambda *rows: frame(spark, "vehicles", list(rows))
    days = [dt.date(2026, 1, d) for d in (1, 10, 10, 20, 5)]
    states = [
        seen(vehicle(1), vehicle(2)),
        seen(vehicle(1, status="maintenance"), vehicle(2), vehicle(3)),
        seen(vehicle(1, status="inactive"), vehicle(3)),  # the same day again: no version of length 0
        seen(vehicle(1, status="active"), vehicle(3), vehicle(3)),
        seen(vehicle(3, status="maintenance")),  # a day before the current version began: nothing to open
    ]
    out = spark.createDataFrame([], schema)
    for day, rows in zip(days, states, strict=True):
        out = spark.createDataFrame(history.close_out(out, rows, key, day, schema).collect(), schema)
    got = sorted((r.vehicle_id, r.version, r.status, r.valid_from.day, r.valid_to, r.is_current) for r in out.collect())
    end = dt.date(2099, 12, 31)
    assert got == [
        (1, 1, "active", 1, dt.date(2026, 1, 9), False), (1, 2, "inactive", 10, dt.date(2026, 1, 19), False),
        (1, 3, "active", 20, end, True), (2, 1, "active", 1, end, True), (3, 1, "active", 10, end, True),
    ]
    rows = spark.createDataFrame(
        [(1, dt.date(2025, 5, 5)), (1, dt.date(2026, 1, 9)), (1, dt.date(2026, 1, 10)), (1, dt.date(2030, 1, 1)),
         (1, None), (None, dt.date(2026, 1, 9)), (9, dt.date(2026, 1, 9)), (3, dt.date(2026, 1, 1))],
        "vehicle_id long, day date",
    )
    dated = history.valid_at(rows, out, key, "day", ["version"]).collect()
    assert sorted((r.vehicle_id, r.day, r.version) for r in dated) == [
        (1, dt.date(2025, 5, 5), 1), (1, dt.date(2026, 1, 9), 1), (1, dt.date(2026, 1, 10), 2), (1, dt.date(2030, 1, 1), 3),
        (3, dt.date(2026, 1, 1), 1),
    ]


def test_batches_keep_history_when_asked(spark, scratch):
    wh = Warehouse(spark, scratch)
    run_pipeline(spark, fleet(spark), wh, dt.date(2026, 11, 20), batch_id=1, keep_history=True)
    changed = fleet(spark, vehicles=[vehicle(1, status="maintenance"), vehicle(2)])
    again = run_pipeline(spark, changed, wh, AS_OF, batch_id=2, keep_history=True)
    assert again.records_loaded == 0  # a vehicle's status is in no fact
    got = sorted((r.vehicle_id, r.version, r.status, r.is_current) for r in wh.read("vehicle_history").collect())
    assert got == [(1, 1, "active", False), (1, 2, "maintenance", True), (2, 1, "active", True)]
    assert wh.read("driver_history").count() == 2 and wh.read("dim_vehicle").count() == 2
