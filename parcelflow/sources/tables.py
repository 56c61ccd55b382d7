"""A named set of the six operational tables as DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

TABLE_NAMES = ("vehicles", "drivers", "routes", "trips", "deliveries", "maintenance")


class FleetTables:
    """Lazily built operational tables.

    Each table is created on first access from a loader, so a report that
    reads two tables never plans a scan of the other four.
    """

    def __init__(self, loaders: dict[str, Callable[[], DataFrame]]):
        missing = set(TABLE_NAMES) - set(loaders)
        if missing:
            raise ValueError(f"missing loaders for {sorted(missing)}")
        self._loaders = dict(loaders)
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._loaders[name]()
        return self._cache[name]

    @property
    def vehicles(self) -> DataFrame:
        return self.table("vehicles")

    @property
    def drivers(self) -> DataFrame:
        return self.table("drivers")

    @property
    def routes(self) -> DataFrame:
        return self.table("routes")

    @property
    def trips(self) -> DataFrame:
        return self.table("trips")

    @property
    def deliveries(self) -> DataFrame:
        return self.table("deliveries")

    @property
    def maintenance(self) -> DataFrame:
        return self.table("maintenance")

    def register_views(self, prefix: str = "") -> None:
        """Expose the six tables as temp views (``vehicles``, ``trips``, ...) for SQL users."""
        for name in TABLE_NAMES:
            self.table(name).createOrReplaceTempView(f"{prefix}{name}")

    @classmethod
    def from_frames(cls, **frames: DataFrame) -> "FleetTables":
        return cls({name: (lambda df=df: df) for name, df in frames.items()})
