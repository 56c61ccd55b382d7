"""What earlier batches did with every delivery, and what has changed since.

A delivery's fingerprint covers everything its fact row comes from: the
delivery, its trip, and of the trip's route, vehicle and driver what reaches
the fact. So a changed toll changes the fingerprints of that route's deliveries
and of no others, and a missing driver, vehicle or name that turns up changes
those of the deliveries that waited for it.

``load_state`` has a row per delivery and change: loaded (with the fact's date)
or rejected (with the reason). It is appended to in hash buckets of
``delivery_id``, sorted, so a batch reads the buckets and id range it needs and
writes only what changed; buckets with many small versions are rewritten now
and then.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import calendar as cal
from parcelflow.operators import etl
from parcelflow.sinks.warehouse import Warehouse
from parcelflow.sources.tables import FleetTables

# Versions of a bucket after which it is rewritten as one.
MOST_VERSIONS = 16

# Why a delivery is not in the fact, the first that holds.
FILTERED, NO_TRIP, NO_ROUTE, NO_VEHICLE, NO_DRIVER, NO_CUSTOMER, UNRESOLVED = (
    "filtered", "no_trip", "no_route", "no_vehicle", "no_driver", "no_customer", "unresolved",
)


def bucket_of(wh: Warehouse) -> Column:
    return F.pmod(F.xxhash64("delivery_id"), F.lit(wh.state_buckets)).cast("int")


def trip_lineage(t: FleetTables) -> DataFrame:
    """``trip_id, _lineage, _missing``: a fingerprint of what a trip gives its deliveries' fact rows, and what it lacks."""
    trip = [F.col(c) for c in sorted(t.trips.columns)]
    rows = t.trips.select("trip_id", "route_id", "vehicle_id", "driver_id", F.xxhash64(*trip).alias("_trip"))
    routes = t.routes.select("route_id", F.xxhash64("distance_km", "toll_cost").alias("_route"))
    vehicles = t.vehicles.select("vehicle_id", F.lit(True).alias("_vehicle"))
    drivers = t.drivers.select("driver_id", F.col("employee_code").isNotNull().alias("_driver"))
    found = rows.join(routes, "route_id", "left").join(vehicles, "vehicle_id", "left").join(drivers, "driver_id", "left")
    has_driver = F.coalesce("_driver", F.lit(False))
    missing = (
        F.when(F.col("_route").isNull(), NO_ROUTE).when(F.col("_vehicle").isNull(), NO_VEHICLE).when(~has_driver, NO_DRIVER)
    )
    lineage = F.xxhash64("_trip", "_route", F.col("_vehicle").isNotNull(), has_driver)
    return found.select("trip_id", lineage.alias("_lineage"), missing.alias("_missing"))


def source_state(t: FleetTables, as_of: _dt.date, days: int) -> DataFrame:
    """``delivery_id, trip_id, fingerprint, reason`` of the window's deliveries as they are now.

    Only narrow columns of the tables are read and joined. ``reason`` says
    why a delivery cannot be loaded, null where nothing speaks against it.
    """
    since = cal.days_before(as_of, days)
    own = [F.col(c) for c in sorted(t.deliveries.columns)]
    d = t.deliveries.where(F.col("delivered_datetime") >= F.lit(since)).select(
        "delivery_id", "trip_id", F.xxhash64(*own).alias("_delivery"),
        F.coalesce(etl.kept_by_transform(), F.lit(False)).alias("_kept"),
        F.col("customer_name").isNotNull().alias("_named"),
    )
    found = d.join(trip_lineage(t), "trip_id", "left")
    reason = (
        F.when(~F.col("_kept"), FILTERED)
        .when(F.col("_lineage").isNull(), NO_TRIP)
        .when(F.col("_missing").isNotNull(), F.col("_missing"))
        .when(~F.col("_named"), NO_CUSTOMER)
    )
    return found.select(
        "delivery_id", "trip_id", F.xxhash64("_delivery", "_lineage").alias("fingerprint"), reason.alias("reason")
    )


def newest_state(rows: DataFrame) -> DataFrame:
    """The last row of every delivery."""
    last = F.max(F.struct("snapshot", "trip_id", "fingerprint", "date_key", "reason")).alias("_last")
    return rows.groupBy("delivery_id").agg(last).select("delivery_id", "_last.*")


def known_state(wh: Warehouse, now: DataFrame) -> DataFrame:
    """The state of the deliveries of ``now`` (a stored frame): only their buckets, and in these their range of ids."""
    need = now.agg(
        F.min("delivery_id").alias("low"), F.max("delivery_id").alias("high"), F.collect_set(bucket_of(wh)).alias("buckets")
    ).first()  # as many buckets as there are
    rows = wh.read("load_state").where(F.col("bucket").isin(sorted(need.buckets)))
    if need.low is not None:
        rows = rows.where(F.col("delivery_id").between(need.low, need.high))
    return newest_state(rows)


def compared(now: DataFrame, known: DataFrame) -> DataFrame:
    """``now`` with ``old_trip_id``, ``old_date_key`` and ``changed``: neither loaded nor rejected as it is now."""
    old = known.select(
        "delivery_id", F.col("fingerprint").alias("_old"), F.col("trip_id").alias("old_trip_id"),
        F.col("date_key").alias("old_date_key"),
    )
    both = now.join(old, "delivery_id", "left")
    return both.withColumn("changed", ~F.col("fingerprint").eqNullSafe(F.col("_old"))).drop("_old")


def touched_trips(found: DataFrame) -> DataFrame:
    """Trips with a changed delivery, and the trips such deliveries were on before."""
    changed = found.where("changed")
    trips = changed.select("trip_id").union(changed.select(F.col("old_trip_id").alias("trip_id")))
    return trips.where("trip_id IS NOT NULL").distinct()


def touched_rows(found: DataFrame, trips: DataFrame) -> DataFrame:
    """All deliveries of touched trips, and the changed ones that have no trip."""
    marked = found.join(trips.withColumn("_touched", F.lit(True)), "trip_id", "left")
    return marked.where(F.col("_touched") | F.col("changed")).drop("_touched")


def append_state(wh: Warehouse, touched: DataFrame, loaded: DataFrame, snapshot: int) -> None:
    """Record what became of the touched deliveries; rows that say nothing new are left out."""
    dates = loaded.select("delivery_id", "date_key")
    now = touched.join(dates, "delivery_id", "left")
    news = F.col("changed") | ~F.col("date_key").eqNullSafe(F.col("old_date_key"))
    reason = F.when(F.col("date_key").isNull(), F.coalesce("reason", F.lit(UNRESOLVED)))
    rows = now.where(news).select(
        bucket_of(wh).alias("bucket"), "delivery_id", "trip_id", "fingerprint", "date_key", reason.alias("reason"),
        F.lit(int(snapshot)).cast("bigint").alias("snapshot"),
    )
    wh.append("load_state", _in_buckets(rows), ["bucket"])
    versions: dict[str, int] = {}
    for _, part in wh.segments("load_state"):
        versions[part] = versions.get(part, 0) + 1
    many = [int(part.removeprefix("bucket=")) for part, n in versions.items() if n > MOST_VERSIONS]
    if many:
        whole = newest_state(wh.read("load_state").where(F.col("bucket").isin(many)))
        wh.replace_partitions("load_state", _in_buckets(whole.withColumn("bucket", bucket_of(wh))), ["bucket"])


def _in_buckets(rows: DataFrame) -> DataFrame:
    """One file per bucket, sorted, so that files and row groups have narrow ranges of ids."""
    return rows.repartition("bucket").sortWithinPartitions("bucket", "delivery_id")


def rejected_deliveries(wh: Warehouse) -> DataFrame:
    """``delivery_id, trip_id, reason, snapshot`` of the deliveries that batches have seen and not loaded."""
    return newest_state(wh.read("load_state")).where("date_key IS NULL").select("delivery_id", "trip_id", "reason", "snapshot")
