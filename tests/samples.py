"""Small inputs shared by the tests."""

from __future__ import annotations

import json
from datetime import UTC, date, datetime, timedelta

from staytally.schema import PAGE_SCHEMA, SNAPSHOT_SCHEMA

STAMP = datetime(2026, 9, 27, 6, tzinfo=UTC)
START = date(2028, 2, 28)
HOTELS = [("north", ["single", "double"]), ("south", ["single"])]
HOTEL_FORM = "hotel_id string, room_type_ids array<string>"


def hotels(spark, entries=HOTELS):
    return spark.createDataFrame(entries, HOTEL_FORM)


def items(days=3, start=START, entries=HOTELS):
    """Complete records per hotel; the count is arbitrary but never repeats by accident."""
    return {
        hotel: [
            {
                "room_type_id": room,
                "date": (start + timedelta(days=day)).isoformat(),
                "available": day * 10 + number,
            }
            for number, room in enumerate(rooms)
            for day in range(days)
        ]
        for hotel, rooms in entries
    }


def page(records, cursor=None):
    return json.dumps({"items": records, "next_cursor": cursor})


def pages(spark, payloads, page_size=2):
    """Landed pages of each hotel's records, with offset cursors."""
    landed = []
    for hotel, records in payloads.items():
        for number, first in enumerate(range(0, max(len(records), 1), page_size)):
            following = first + page_size
            cursor = str(following) if following < len(records) else None
            asked = str(first) if number else None
            landed.append((hotel, number + 1, asked, page(records[first:following], cursor)))
    return spark.createDataFrame(landed, PAGE_SCHEMA)


def row(
    hotel="demo",
    room="double",
    stay=date(2026, 9, 27),
    rooms=7,
    at=datetime(2026, 9, 27, 6, tzinfo=UTC),
    day=None,
):
    return (hotel, room, stay, rooms, day or at.astimezone(UTC).date(), at)


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SNAPSHOT_SCHEMA)


def listed(frame):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in frame.collect()), key=repr)
