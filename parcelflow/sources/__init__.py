"""Sources: operational tables from Parquet, JDBC or the test tables."""

from parcelflow.sources.catalog import fleet_tables_from_catalog, write_fleet_catalog
from parcelflow.sources.driver_tables import fleet_tables_from_driver_data
from parcelflow.sources.parquet import fleet_tables_from_parquet, scan_table, write_fleet_tables
from parcelflow.sources.tables import TABLE_NAMES, FleetTables

__all__ = [
    "FleetTables",
    "TABLE_NAMES",
    "fleet_tables_from_catalog",
    "fleet_tables_from_driver_data",
    "fleet_tables_from_parquet",
    "scan_table",
    "write_fleet_catalog",
    "write_fleet_tables",
]
