"""One ETL batch into an empty warehouse, as pure DataFrames.

These plans compute what the pipeline would write on its first run, without
writing warehouse tables, so every stage can be registered as a query and
compared with its SQL oracle. Where the pipeline stages a frame to its
warehouse folder, these plans checkpoint it instead (``staged=True``).
``parcelflow.plans.pipeline`` runs the same operators against a persisted
warehouse.
"""

from __future__ import annotations

import calendar as _calendar
import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from parcelflow import schemas
from parcelflow.functions import calendar as cal
from parcelflow.operators import dimensions as dims
from parcelflow.operators import etl, fact
from parcelflow.session import ensure_checkpoint_dir
from parcelflow.sources.tables import FleetTables


def batch_id_for(as_of: _dt.date | str) -> int:
    """Epoch seconds of ``as_of`` at midnight UTC: a run's default batch id."""
    d = cal.as_date(as_of)
    return _calendar.timegm(d.timetuple())


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], schemas.WAREHOUSE[name])


class FirstLoad:
    """Lazily built stages of one batch over ``tables`` as of ``as_of``."""

    def __init__(self, tables: FleetTables, as_of: _dt.date | str, batch_id: int | None = None, staged: bool = False):
        self.t = tables
        self.staged = staged
        self.as_of = cal.as_date(as_of)
        self.batch_id = batch_id if batch_id is not None else batch_id_for(self.as_of)
        self._memo: dict[str, DataFrame] = {}

    @property
    def spark(self) -> SparkSession:
        return self.t.deliveries.sparkSession

    def _get(self, key: str, build) -> DataFrame:
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def extracted(self) -> DataFrame:
        t = self.t
        return self._get(
            "extracted",
            lambda: etl.extract_daily(t.deliveries, t.trips, t.routes, t.vehicles, t.drivers, self.as_of),
        )

    def transformed(self) -> DataFrame:
        """The transformed batch: a plain plan, or checkpointed where several steps read it.

        Built as the pipeline builds it (per-trip sizes counted with the
        extract). With ``staged`` it goes to the session's reliable
        checkpoint folder, as the pipeline stages it; else every reader
        prunes the plan to its own columns.
        """

        def build() -> DataFrame:
            t = self.t
            extracted = etl.extract_daily(
                t.deliveries, t.trips, t.routes, t.vehicles, t.drivers, self.as_of, with_trip_sizes=True
            )
            out = etl.transform_all(extracted, self.as_of)
            if not self.staged:
                return out
            ensure_checkpoint_dir(self.spark)
            return out.checkpoint(eager=True)

        return self._get("transformed", build)

    def dim_vehicle(self) -> DataFrame:
        return self._get(
            "dim_vehicle",
            lambda: dims.vehicle_inserts(
                dims.stage_vehicles(self.transformed()), empty(self.spark, "dim_vehicle"), self.as_of
            ),
        )

    def dim_driver(self) -> DataFrame:
        return self._get(
            "dim_driver",
            lambda: dims.driver_inserts(
                dims.stage_drivers(self.transformed()), empty(self.spark, "dim_driver"), self.as_of
            ),
        )

    def dim_route(self) -> DataFrame:
        return self._get(
            "dim_route",
            lambda: dims.route_inserts(dims.stage_routes(self.transformed()), empty(self.spark, "dim_route")),
        )

    def dim_customer(self) -> DataFrame:
        return self._get(
            "dim_customer",
            lambda: dims.customer_inserts(
                dims.stage_customers(self.transformed()), empty(self.spark, "dim_customer"), self.as_of
            ),
        )

    def dim_date(self) -> DataFrame:
        return self._get(
            "dim_date", lambda: dims.date_inserts(self.transformed(), empty(self.spark, "dim_date"))
        )

    def dim_time(self) -> DataFrame:
        return self._get(
            "dim_time", lambda: dims.time_inserts(self.transformed(), empty(self.spark, "dim_time"))
        )

    def fact(self) -> DataFrame:
        def build() -> DataFrame:
            maps = dims.key_maps(self.dim_vehicle(), self.dim_driver(), self.dim_route(), self.dim_customer())
            return fact.fact_rows(self.transformed(), maps, self.batch_id)

        return self._get("fact", build)

    def totals(self) -> DataFrame:
        return self._get("totals", lambda: fact.daily_totals(self.fact()))

    def sales_view(self) -> DataFrame:
        return fact.sales_view(self.fact(), self.dim_date(), self.dim_customer())

    def operations_view(self) -> DataFrame:
        return fact.operations_view(
            self.fact(), self.dim_date(), self.dim_time(), self.dim_vehicle(), self.dim_driver(),
            self.dim_route(), self.dim_customer(),
        )


def customers_after_two_loads(tables: FleetTables, first_as_of: _dt.date, second_as_of: _dt.date) -> DataFrame:
    """``dim_customer`` after two batches: the second only adds unseen names.

    Shows the insert-if-absent MERGE: names of the first batch keep their
    keys and city; new names continue the key sequence.
    """
    first = FirstLoad(tables, first_as_of).dim_customer()
    second = FirstLoad(tables, second_as_of)
    added = dims.customer_inserts(dims.stage_customers(second.transformed()), first, second_as_of)
    return first.unionByName(added)
