import datetime as dt
import os
from decimal import Decimal as D

from builders import TS, delivery, driver, frame, route, tables, trip, vehicle
from pyspark.sql import functions as F

from parcelflow import schemas
from parcelflow.operators import dimensions as dims
from parcelflow.operators import etl, fact, keys
from parcelflow.plans.first_load import FirstLoad
from parcelflow.plans.pipeline import run_pipeline
from parcelflow.sinks.warehouse import Warehouse

AS_OF = dt.date(2026, 12, 1)


def small_fleet(spark, extra_deliveries=(), trips_extra=()):
    return tables(
        spark,
        vehicles=[vehicle(1), vehicle(2)],
        drivers=[driver(1), driver(2)],
        routes=[route(1)],
        trips=[trip(1, vid=1, did=1), trip(2, vid=2, did=None), *trips_extra],
        deliveries=[
            delivery(11, tid=1, customer="Ana"),
            delivery(12, tid=1, customer="Bea", weight="0"),
            delivery(13, tid=1, customer="Ana", sched=TS(2026, 11, 2, 8, 0)),
            delivery(21, tid=2, customer="Caro"),
            *extra_deliveries,
        ],
    )


def test_trip_size_counts_rows_left_after_filters(spark):
    t = small_fleet(spark)
    ext = etl.extract_daily(t.deliveries, t.trips, t.routes, t.vehicles, t.drivers, AS_OF)
    out = {r.delivery_id: r for r in etl.transform_all(ext, AS_OF).collect()}
    assert set(out) == {11, 13, 21}
    assert out[11].deliveries_in_trip == 2 and out[13].deliveries_in_trip == 2
    # (40 l x 5000 + 60000 toll) / 2 deliveries
    assert out[11].cost_per_delivery == D("130000.00")
    assert out[11].full_name == "Ana Diaz"
    assert out[21].first_name is None  # trip 2 has no driver: left join keeps the row


def test_on_time_flags(spark):
    base = TS(2026, 11, 2, 9, 0)
    rows = [delivery(i, sched=base, delivered=base + dt.timedelta(minutes=mins))
            for i, mins in enumerate([-5, 30, 30.01], start=1)]
    t = tables(spark, vehicles=[vehicle(1)], drivers=[driver(1)], routes=[route(1)], trips=[trip(1)],
               deliveries=rows)
    ext = etl.extract_daily(t.deliveries, t.trips, t.routes, t.vehicles, t.drivers, AS_OF)
    got = sorted((r.delivery_id, r.delay_minutes, r.is_on_time) for r in etl.transform_all(ext, AS_OF).collect())
    assert got == [(1, D("0.00"), True), (2, D("30.00"), True), (3, D("30.01"), False)]


def test_merge_inserts_only_new_keys(spark):
    existing = dims.vehicle_inserts(
        frame(spark, "vehicles", [vehicle(1)]).select(
            "vehicle_id", "license_plate", "vehicle_type", "capacity_kg", "fuel_type", "acquisition_date",
            F.lit(10).alias("age_months"), F.col("status").alias("vehicle_status")),
        spark.createDataFrame([], schemas.DIM_VEHICLE), AS_OF)
    staged = spark.createDataFrame(
        [(1, "CHANGED", "Van", D("1.00"), "x", None, 1, "active"),
         (2, "NEW", "Van", D("1.00"), "x", None, 1, "active"),
         (2, "NEW", "Van", D("1.00"), "x", None, 1, "active")],
        "vehicle_id bigint, license_plate string, vehicle_type string, capacity_kg decimal(10,2), "
        "fuel_type string, acquisition_date date, age_months int, vehicle_status string",
    )
    staged = keys.dedupe_keep_first(staged, ["vehicle_id"], ["license_plate"])
    merged = existing.unionByName(dims.vehicle_inserts(staged, existing, AS_OF))
    got = sorted((r.vehicle_id, r.license_plate) for r in merged.collect())
    assert got == [(1, "PLT1"), (2, "NEW")]


def test_null_driver_never_reaches_dimension_or_fact(spark):
    load = FirstLoad(small_fleet(spark), AS_OF)
    assert sorted(r.driver_id for r in load.dim_driver().collect()) == [1]
    assert 21 not in {r.delivery_id for r in load.fact().collect()}


def test_customer_city_is_first_delivery_and_keys_dense(spark):
    load = FirstLoad(small_fleet(spark), AS_OF)
    rows = sorted((r.customer_name, r.customer_key, r.city) for r in load.dim_customer().collect())
    assert rows == [("Ana", 1, "Cali"), ("Caro", 2, "Cali")]


def test_sequential_keys_span_slices(spark):
    names = spark.createDataFrame([(f"n{i:05d}",) for i in range(1000)], "name string")
    keyed = keys.assign_sequential_keys(names, ["name"], 101, "k", slices=7)
    got = sorted((r.name, r.k) for r in keyed.collect())
    assert [k for _, k in got] == list(range(101, 1101))


def test_dedupe_is_deterministic_on_ties(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (2, 1, "z")], "k int, o int, v string")
    got = sorted(tuple(r) for r in keys.dedupe_keep_first(df, ["k"], ["o"]).collect())
    assert got == [(1, 5, "a"), (2, 1, "z")]


def test_group_values_meet_hot_and_null_keys(spark):
    df = spark.createDataFrame([(i, None if i % 10 == 0 else i % 2) for i in range(100)], "id int, k int")
    sizes = df.where("k IS NOT NULL").groupBy("k").count()
    got = keys.join_group_values(df, sizes, "k", salts=4).collect()
    assert len(got) == 100 and {(r.k, r["count"]) for r in got} == {(None, None), (0, 40), (1, 50)}


def test_pipeline_idempotent_and_touched_trips_derived_anew(spark, scratch):
    t = small_fleet(spark)
    wh = Warehouse(spark, scratch)
    first = run_pipeline(spark, t, wh, AS_OF, batch_id=7)
    assert (first.records_extracted, first.records_transformed, first.records_loaded) == (4, 3, 2)
    again = run_pipeline(spark, t, wh, AS_OF, batch_id=7)
    assert again.records_loaded == 0
    assert wh.read("fact_deliveries").count() == 2
    totals = [(r.num_entregas, r.etl_batch_id) for r in wh.read("daily_totals").collect()]
    assert totals == [(2, 7)]
    later = run_pipeline(
        spark,
        small_fleet(spark, extra_deliveries=[delivery(14, tid=1, customer="Dora")]),
        wh, AS_OF, batch_id=8,
    )
    # the new delivery changes what its trip's other deliveries cost
    assert later.records_loaded == 3
    costs = {r.delivery_id: r.cost_per_delivery for r in wh.read("fact_deliveries").collect()}
    assert costs == dict.fromkeys((11, 13, 14), D("86666.67"))
    got = sorted((r.etl_batch_id, r.num_entregas) for r in wh.read("daily_totals").collect())
    assert got == [(8, 3)]  # one row per date
    cust = sorted((r.customer_name, r.customer_key) for r in wh.read("dim_customer").collect())
    assert cust == [("Ana", 1), ("Caro", 2), ("Dora", 3)]
    audit = sorted(r.etl_batch_id for r in wh.read("etl_batch_metrics").collect())
    assert audit == [7, 7, 8]
    assert not os.path.exists(wh.stage_path(8))
    from parcelflow.plans.pipeline import warehouse_key_report

    assert sum(r.violations for r in warehouse_key_report(wh).collect()) == 0


def test_rescheduled_and_moved_deliveries_are_loaded_once(spark, scratch):
    wh = Warehouse(spark, scratch)
    trips = [trip(3, vid=1, did=1)]
    run_pipeline(spark, small_fleet(spark, [delivery(31, tid=3), delivery(32, tid=3)], trips), wh, AS_OF, batch_id=1)
    moved = [delivery(31, tid=1, sched=TS(2026, 11, 20, 9, 0), delivered=TS(2026, 11, 20, 9, 5)), delivery(32, tid=3)]
    now = small_fleet(spark, moved, trips)
    run_pipeline(spark, now, wh, AS_OF, batch_id=2)
    once = Warehouse(spark, scratch + "/once")
    run_pipeline(spark, now, once, AS_OF, batch_id=2)
    # batch ids tell which batch touched a row last
    columns = [c for c in fact.FACT_COLUMNS if c not in ("customer_key", "etl_batch_id")]
    for name, keep in (("fact_deliveries", columns), ("daily_totals", ["date_key", "num_entregas", "avg_delivery_time"])):
        a, b = wh.read(name).select(*keep), once.read(name).select(*keep)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 0
    # a date that lost its last delivery has neither rows nor totals
    gone = [delivery(31, tid=1, sched=TS(2026, 11, 21, 9, 0), delivered=TS(2026, 11, 21, 9, 5)), delivery(32, tid=3)]
    run_pipeline(spark, small_fleet(spark, gone, trips), wh, AS_OF, batch_id=3)
    dates = {r.date_key for r in wh.read("daily_totals").collect()}
    assert 20261121 in dates and 20261120 not in dates
    assert {r.date_key for r in wh.read("fact_deliveries").collect()} == dates


def test_repeated_dimension_row_multiplies_nothing(spark, scratch):
    wh = Warehouse(spark, scratch)
    run_pipeline(spark, small_fleet(spark), wh, AS_OF, batch_id=1)
    wh.append("dim_customer", wh.read("dim_customer").withColumn("customer_key", F.col("customer_key") + 100))
    run_pipeline(spark, small_fleet(spark, [delivery(14, tid=1, customer="Ana")]), wh, AS_OF, batch_id=2)
    facts = wh.read("fact_deliveries").collect()
    assert sorted(r.delivery_id for r in facts) == [11, 13, 14] and {r.customer_key for r in facts} == {1}


def test_daily_totals_round_half_up(spark):
    rows = [(20261102, D("10.00"), D("1.00"), True, 1), (20261102, D("20.00"), D("2.01"), False, 1),
            (20261102, D("30.00"), D("2.00"), False, 1), (20261102, D("40.00"), D("3.00"), False, 1),
            (20261102, D("50.00"), D("4.00"), False, 1), (20261102, D("60.00"), D("5.00"), False, 1),
            (20261102, D("70.00"), D("6.00"), False, 1), (20261102, D("80.00"), D("7.00"), False, 1)]
    f = spark.createDataFrame(rows, "date_key int, revenue_per_delivery decimal(10,2), "
                                    "delivery_time_minutes decimal(12,2), is_on_time boolean, etl_batch_id bigint")
    r = fact.daily_totals(f).first()
    assert (r.num_entregas, r.total_revenue) == (8, D("360.00"))
    assert r.avg_delivery_time == D("3.75")  # 30.01 / 8 = 3.75125
    assert r.on_time_rate == D("0.13")  # 1 / 8 = 0.125 rounds up


def test_hot_trip_with_a_third_of_rows(spark):
    """One trip holds a third of all deliveries: sizes stay exact and no window is planned."""
    hot = [delivery(i, tid=1, customer=f"C{i % 7}") for i in range(1, 301)]
    cold = [delivery(1000 + i, tid=2 + i % 50, customer=f"C{i % 7}") for i in range(600)]
    t = tables(
        spark,
        vehicles=[vehicle(1)],
        drivers=[driver(1)],
        routes=[route(1)],
        trips=[trip(i, vid=1, did=1, rid=1) for i in range(1, 52)],
        deliveries=hot + cold,
    )
    ext = etl.extract_daily(t.deliveries, t.trips, t.routes, t.vehicles, t.drivers, AS_OF)
    out = etl.transform_all(ext, AS_OF)
    sizes = {r.trip_id: r.deliveries_in_trip for r in out.select("trip_id", "deliveries_in_trip").distinct().collect()}
    assert sizes[1] == 300 and sizes[2] == 12 and len(sizes) == 51
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    deduped = keys.dedupe_keep_first(t.deliveries, ["trip_id"], ["scheduled_datetime", "delivery_id"])
    assert {r.trip_id: r.delivery_id for r in deduped.collect()}[1] == 1


def test_trip_sizes_from_extract_match_counting_after_transform(spark):
    from parcelflow.sources.driver_tables import fleet_tables_from_driver_data

    t = fleet_tables_from_driver_data(spark, "/root/testdata/sf0.001")
    as_of = dt.date(2001, 9, 1)
    plain = etl.transform_all(
        etl.extract_daily(t.deliveries, t.trips, t.routes, t.vehicles, t.drivers, as_of), as_of
    )
    fused = etl.transform_all(
        etl.extract_daily(t.deliveries, t.trips, t.routes, t.vehicles, t.drivers, as_of, with_trip_sizes=True),
        as_of,
    )
    assert plain.columns == fused.columns
    assert plain.count() == fused.count() > 0
    assert plain.exceptAll(fused).count() == 0 and fused.exceptAll(plain).count() == 0
    # and on the hand-made fleet with a zero-weight row and a driverless trip
    small = small_fleet(spark)
    a = etl.transform_all(etl.extract_daily(small.deliveries, small.trips, small.routes, small.vehicles,
                                            small.drivers, AS_OF), AS_OF)
    b = etl.transform_all(etl.extract_daily(small.deliveries, small.trips, small.routes, small.vehicles,
                                            small.drivers, AS_OF, with_trip_sizes=True), AS_OF)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rerun_after_a_failed_batch_leaves_no_duplicates(spark, scratch, monkeypatch):
    import pytest

    import parcelflow.plans.pipeline as pipeline

    t = small_fleet(spark)
    wh = Warehouse(spark, scratch)

    def broken(*args, **kwargs):
        raise RuntimeError("executor lost during the fact load")

    monkeypatch.setattr(pipeline, "load_facts", broken)
    with pytest.raises(RuntimeError):
        pipeline.run_pipeline(spark, t, wh, AS_OF, batch_id=9)
    monkeypatch.undo()
    assert wh.read("dim_customer").count() == 0 and not wh.exists("fact_deliveries")  # one commit for all tables
    assert [(r.etl_batch_id, r.errors) for r in wh.read("etl_batch_metrics").collect()] == [(9, 1)]

    metrics = pipeline.run_pipeline(spark, t, wh, AS_OF, batch_id=9)
    assert metrics.records_loaded == 2
    assert wh.read("dim_customer").count() == 2  # no second copy of the dimension rows
    assert sum(r.violations for r in pipeline.warehouse_key_report(wh).collect()) == 0
    assert [(r.etl_batch_id, r.num_entregas) for r in wh.read("daily_totals").collect()] == [(9, 2)]


def test_null_customer_names_are_not_staged(spark):
    t = small_fleet(spark, extra_deliveries=[delivery(15, tid=1, customer=None)])
    load = FirstLoad(t, AS_OF)
    names = sorted(r.customer_name for r in load.dim_customer().collect())
    assert names == ["Ana", "Caro"]
