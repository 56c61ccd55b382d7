"""Hand-made operational rows for micro-fixtures."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from parcelflow import schemas
from parcelflow.sources.tables import FleetTables

D = Decimal
TS = dt.datetime
DAY = dt.date


def frame(spark, name, rows):
    """A DataFrame of operational table ``name`` from dict rows (missing keys are NULL)."""
    schema = schemas.OLTP[name]
    tuples = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(tuples, schema)


def vehicle(vid, vtype="Van", capacity="1500", status="active", **kw):
    row = dict(vehicle_id=vid, license_plate=f"PLT{vid}", vehicle_type=vtype, capacity_kg=D(capacity),
               fuel_type="gasolina", acquisition_date=DAY(2024, 1, 15), status=status)
    row.update(kw)
    return row


def driver(did, status="active", expiry=DAY(2027, 6, 1), **kw):
    row = dict(driver_id=did, employee_code=f"EMP{did:04d}", first_name=" Ana", last_name="Diaz ",
               license_expiry=expiry, hire_date=DAY(2020, 3, 10), status=status)
    row.update(kw)
    return row


def route(rid, origin="Bogotá", destination="Cali", distance="460.00", **kw):
    row = dict(route_id=rid, route_code=f"R{rid:03d}", origin_city=origin, destination_city=destination,
               distance_km=D(distance), estimated_duration_hours=D("6.50"), toll_cost=D("60000.00"))
    row.update(kw)
    return row


def trip(tid, vid=1, did=1, rid=1, dep=TS(2026, 11, 2, 8, 0), arr=TS(2026, 11, 2, 12, 0), fuel="40.00",
         weight="900.00", status="completed", **kw):
    row = dict(trip_id=tid, vehicle_id=vid, driver_id=did, route_id=rid, departure_datetime=dep,
               arrival_datetime=arr, fuel_consumed_liters=None if fuel is None else D(fuel),
               total_weight_kg=D(weight), status=status)
    row.update(kw)
    return row


def delivery(did, tid=1, sched=TS(2026, 11, 2, 9, 0), delivered=TS(2026, 11, 2, 9, 10), weight="10.00",
             status="delivered", signature="signed", customer="Cliente A", tracking=None, **kw):
    row = dict(delivery_id=did, trip_id=tid, tracking_number=f"FL2026{did:08d}" if tracking is None else tracking,
               customer_name=customer, package_weight_kg=None if weight is None else D(weight),
               scheduled_datetime=sched, delivered_datetime=delivered, delivery_status=status,
               recipient_signature=signature)
    row.update(kw)
    return row


def tables(spark, vehicles=(), drivers=(), routes=(), trips=(), deliveries=(), maintenance=()):
    return FleetTables.from_frames(
        vehicles=frame(spark, "vehicles", list(vehicles)),
        drivers=frame(spark, "drivers", list(drivers)),
        routes=frame(spark, "routes", list(routes)),
        trips=frame(spark, "trips", list(trips)),
        deliveries=frame(spark, "deliveries", list(deliveries)),
        maintenance=frame(spark, "maintenance", list(maintenance)),
    )
