import datetime as dt
from decimal import Decimal as D

from builders import TS, delivery, driver, frame, route, tables, trip, vehicle

from parcelflow.operators import integrity, reports

AS_OF = dt.date(2026, 12, 1)


def test_expiring_licenses_includes_expired_and_excludes_day_60(spark):
    drivers = frame(spark, "drivers", [
        driver(1, expiry=dt.date(2026, 11, 1)),
        driver(2, expiry=dt.date(2027, 1, 29)),
        driver(3, expiry=dt.date(2027, 1, 30)),
        driver(4, status="inactive", expiry=dt.date(2026, 12, 5)),
    ])
    got = [r.driver_id for r in reports.expiring_licenses(drivers, AS_OF).collect()]
    assert got == [1, 2]


def test_late_uses_absolute_difference(spark):
    base = TS(2026, 11, 2, 9, 0)
    rows = [
        delivery(1, sched=base, delivered=base - dt.timedelta(minutes=60)),
        delivery(2, sched=base, delivered=base + dt.timedelta(minutes=59, seconds=59.4)),
        delivery(3, sched=base, delivered=base + dt.timedelta(minutes=60)),
        delivery(4, sched=base, delivered=None),
    ]
    d = frame(spark, "deliveries", rows)
    got = reports.late_by_weekday(d).collect()
    assert [(r.dia_semana, r.num_pedidos_retrasados) for r in got] == [("monday   ", 2)]
    late_only = reports.late_by_weekday(d, late_only=True).collect()
    assert late_only[0].num_pedidos_retrasados == 1


def test_dense_rank_keeps_ties(spark):
    counts = [9, 9, 8, 7, 6]
    drivers, trips, deliveries = [], [], []
    did = 1
    for i, n in enumerate(counts, start=1):
        drivers.append(driver(i, last_name=f"D{i}"))
        trips.append(trip(i, did=i))
        for _ in range(n):
            deliveries.append(delivery(did, tid=i, sched=TS(2026, 11, 3, 9), delivered=TS(2026, 11, 3, 10)))
            did += 1
    t = tables(spark, drivers=drivers, trips=trips, deliveries=deliveries)
    got = reports.driver_ranking(t.deliveries, t.trips, t.drivers, AS_OF).collect()
    assert [(r.num_entregas, r.posicion_ranking) for r in got] == [(9, 1), (9, 1), (8, 2), (7, 3)]
    assert {r.mes for r in got} == {"November"}
    assert all(r.promedio_entregas_diario == D(r.num_entregas) for r in got)


def test_trend_growth_and_projection(spark):
    months = [(dt.datetime(2026, m, 10), n) for m, n in zip((1, 2, 3, 4), (100, 150, 0, 10))]
    rows, tid = [], 1
    for arrival, n in months:
        for _ in range(n):
            rows.append(trip(tid, arr=arrival))
            tid += 1
    # March has no trips at all, so it is no group: April's previous month is February.
    t = frame(spark, "trips", rows)
    got = {r.periodo: r for r in reports.trip_trend(t).collect()}
    assert set(got) == {"01 2026", "02 2026", "04 2026"}
    assert got["02 2026"].viajes_mes_anterior == 100
    assert got["02 2026"].porcentaje_crecimiento == 50
    assert got["02 2026"].proyeccion_sig_mes == 225
    assert got["04 2026"].viajes_mes_anterior == 150
    assert got["04 2026"].porcentaje_crecimiento == -93
    assert got["01 2026"].porcentaje_crecimiento is None


def test_trend_skips_month_without_completed_trips(spark):
    # Monthly counts 100, 150, 0 (one in-progress trip only), 10.
    df = spark.createDataFrame(
        [(dt.datetime(2026, m, 1), n) for m, n in zip((1, 2, 3, 4), (100, 150, 0, 10))],
        "arrival_datetime timestamp_ntz, n bigint",
    )
    from pyspark.sql import functions as F

    expanded = df.select(
        F.explode(F.array_repeat(F.col("arrival_datetime"), F.col("n").cast("int"))).alias("arrival_datetime")
    )
    zero_month = spark.createDataFrame([(dt.datetime(2026, 3, 1),)], "arrival_datetime timestamp_ntz")
    trips = expanded.unionByName(zero_month).select(
        F.monotonically_increasing_id().alias("trip_id"), "arrival_datetime",
        F.when(F.month("arrival_datetime") == 3, "in_progress").otherwise("completed").alias("status"),
    )
    got = [(r.viajes_mes_anterior, r.porcentaje_crecimiento, r.proyeccion_sig_mes)
           for r in reports.trip_trend(trips).collect()]
    # March has no completed trip, so the chain is Jan 100, Feb 150, Apr 10.
    assert got == [(150, -93, 1), (100, 50, 225), (None, None, None)]


def test_pivot_zero_fill(spark):
    d = frame(spark, "deliveries", [delivery(1, delivered=TS(2026, 11, 30, 8, 10))])
    rows = reports.hour_weekday_pivot(d).collect()
    assert len(rows) == 1
    r = rows[0].asDict()
    assert r.pop("hora") == 8
    assert r == {"lunes": 1, "martes": 0, "miercoles": 0, "jueves": 0, "viernes": 0, "sabado": 0, "domingo": 0}


def test_maintenance_per_km_has_no_fan_out(spark):
    t = tables(
        spark,
        vehicles=[vehicle(1)],
        routes=[route(1, distance="10.00")],
        trips=[trip(1, vid=1, rid=1), trip(2, vid=1, rid=1)],
        maintenance=[dict(maintenance_id=i, vehicle_id=1, cost=D("5.00")) for i in range(3)],
    )
    r = reports.maintenance_cost_per_km(t.trips, t.routes, t.vehicles, t.maintenance).first()
    assert (r.total_viajes, r.costo_total, r.total_km) == (2, D("15.00"), D("20.00"))
    assert r.costo_mante_porkm == 0.75


def test_fuel_per_km_ratio(spark):
    t = tables(spark, routes=[route(1, distance="100.00")],
               trips=[trip(1, rid=1, fuel="12.34"), trip(2, rid=1, fuel="0.01")])
    r = reports.fuel_per_km(t.routes, t.trips).first()
    assert (r.kilom_recorridos, r.consumo_total_combustible_lt, r.consumo_por_km) == (
        D("200.00"), D("12.35"), D("0.0618"))


def test_integrity_queries(spark):
    t = tables(
        spark,
        vehicles=[vehicle(1, capacity="1000"), vehicle(2, vtype="Camión Grande", capacity="5000")],
        trips=[trip(1, vid=1, weight="100"), trip(2, vid=1, weight="300"), trip(3, vid=2, weight="50"),
               trip(4, vid=2, dep=TS(2026, 1, 2), arr=TS(2026, 1, 1))],
        routes=[route(1), route(2, origin="Bogotá", destination="Barranquilla")],
    )
    mx = {r.vehicle_type: r.max_weigh_kg for r in integrity.max_load_by_type(t.trips, t.vehicles).collect()}
    mn = {r.vehicle_type: r.min_weight_kg for r in integrity.min_load_by_type(t.trips, t.vehicles).collect()}
    assert mx == {"Van": D("300.00"), "Camión Grande": D("900.00")}
    assert mn == {"Van": D("100.00"), "Camión Grande": D("50.00")}
    assert [r.trip_id for r in integrity.filter_time_order(t.trips).collect()] == [4]
    pair = integrity.filter_route_pair(t.routes, "Bogotá", "Barranquilla").collect()
    assert [r.route_code for r in pair] == ["R002"]


def test_monthly_average_groups_by_month_number_only(spark):
    """T4: the same month of two years is one group (as in the reference)."""
    t = tables(
        spark,
        drivers=[driver(1)],
        trips=[trip(1, did=1)],
        deliveries=[
            delivery(1, delivered=TS(2025, 11, 5, 9)),
            delivery(2, delivered=TS(2026, 11, 5, 9)),
            delivery(3, delivered=TS(2026, 10, 5, 9)),
        ],
    )
    r = reports.avg_monthly_deliveries(t.deliveries, t.trips, t.drivers, AS_OF, months=24).first()
    # month 11 has 2 deliveries (two years), month 10 has 1: mean 1.5
    assert r.prom_entregas == D("1.50")


def test_maintenance_report_drops_vehicles_missing_either_side(spark):
    """T19: a vehicle with trips but no maintenance (or the reverse) is not counted."""
    t = tables(
        spark,
        vehicles=[vehicle(1), vehicle(2, vtype="Van"), vehicle(3, vtype="Van")],
        routes=[route(1, distance="10.00")],
        trips=[trip(1, vid=1), trip(2, vid=2)],
        maintenance=[dict(maintenance_id=1, vehicle_id=1, cost=D("5.00")),
                     dict(maintenance_id=2, vehicle_id=3, cost=D("7.00"))],
    )
    rows = reports.maintenance_cost_per_km(t.trips, t.routes, t.vehicles, t.maintenance).collect()
    assert [(r.total_viajes, r.costo_total, r.total_km) for r in rows] == [(1, D("5.00"), D("10.00"))]


def test_trend_orders_months_descending_with_explicit_nulls(spark):
    """T5: months sort newest first; the first month has no previous value (NULL)."""
    t = frame(spark, "trips", [trip(1, arr=TS(2026, 1, 3)), trip(2, arr=TS(2026, 2, 3)),
                               trip(3, arr=TS(2026, 2, 4))])
    got = [(r.periodo, r.viajes_mes_anterior) for r in reports.trip_trend(t).collect()]
    assert got == [("02 2026", 1), ("01 2026", None)]
