"""Sources and sinks: raw scans, the driver-table adapter, the table store."""

from tessera.sources.driver_tables import BATCH_SOURCES, BATCH_STAMPS, DriverTables
from tessera.sources.raw import conform, read_source
from tessera.sources.store import BATCH_COL, Warehouse, layer_name

__all__ = [
    "BATCH_COL",
    "BATCH_SOURCES",
    "BATCH_STAMPS",
    "DriverTables",
    "Warehouse",
    "conform",
    "layer_name",
    "read_source",
]
