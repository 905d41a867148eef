"""staytally: complete, newest-wins daily inventory snapshots on Spark."""

from staytally.errors import SnapshotError, StorageError
from staytally.plans.collect import Snapshot, collect_snapshot, sync_snapshot
from staytally.schema import CELL, COLUMNS, KEY, SNAPSHOT_SCHEMA, UNLIMITED, Limits
from staytally.sinks.table import CatalogTable, SnapshotTable, WriteResult

__all__ = [
    "CELL",
    "COLUMNS",
    "KEY",
    "SNAPSHOT_SCHEMA",
    "UNLIMITED",
    "CatalogTable",
    "Limits",
    "Snapshot",
    "SnapshotError",
    "SnapshotTable",
    "StorageError",
    "WriteResult",
    "collect_snapshot",
    "sync_snapshot",
]
