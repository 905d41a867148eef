"""The canonical snapshot row, its key, and the policy limits of a run."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import types as T

from staytally.errors import SnapshotError

KEY = ["hotel_id", "room_type_id", "snapshot_date", "stay_date"]
CELL = ["hotel_id", "room_type_id", "stay_date"]
PARTITION = "snapshot_date"

SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("hotel_id", T.StringType(), False),
        T.StructField("room_type_id", T.StringType(), False),
        T.StructField("stay_date", T.DateType(), False),
        T.StructField("available_rooms", T.LongType(), False),
        T.StructField("snapshot_date", T.DateType(), False),
        T.StructField("observed_at", T.TimestampType(), False),
    ]
)
COLUMNS = SNAPSHOT_SCHEMA.fieldNames()

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("hotel_id", T.StringType()),
        T.StructField("page_seq", T.LongType()),
        T.StructField("request_cursor", T.StringType()),
        T.StructField("body", T.StringType()),
    ]
)

MAX_INT64 = 2**63 - 1


@dataclass(frozen=True)
class Limits:
    """Acceptance policy. A batch over a limit is refused whole, never trimmed.

    ``None``, the default, is no limit: Spark spills, so these are policy and not
    memory protection.
    """

    max_rows: int | None = None
    max_items: int | None = None
    max_pages: int | None = None
    max_response_bytes: int | None = None
    max_cursor_chars: int | None = None
    max_horizon_days: int | None = None

    def __post_init__(self) -> None:
        for field in fields(self):
            value = getattr(self, field.name)
            if value is None:
                continue
            if type(value) is not int or value < 1:
                raise SnapshotError("bad_option", f"{field.name} must be a positive integer")


UNLIMITED = Limits()
