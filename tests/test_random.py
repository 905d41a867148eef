"""Random inputs against plain sequential models of the same rules."""

import json
from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings, strategies as st

from samples import HOTELS, STAMP, START, hotels, items, page, pages
from staytally import Limits, SnapshotError, collect_snapshot
from staytally.schema import PAGE_SCHEMA
from staytally.sources import pages as P

RELAXED = settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
END = START + timedelta(days=2)

# What one edit does to a complete batch: the reason it is refused for, or None where it stays sound.
EDITS = {
    "nothing": None,
    "copy a record": None,
    "add a field": None,
    "name the own hotel": None,
    "shuffle": None,
    "another count": None,
    "drop a record": "incomplete",
    "drop a hotel's records": "incomplete",
    "copy with another count": "conflict",
    "name another hotel": "wrong_hotel",
    "an unknown room": "unknown_room",
    "a day after the last": "out_of_range",
    "a day before the first": "out_of_range",
    "a day that does not exist": "bad_date",
    "a count as text": "not_integer",
    "a fraction": "not_integer",
    "below zero": "negative",
}


def _edited(edit, payloads, hotel, at, draw):
    records = payloads[hotel]
    record = records[at % len(records)]
    match edit:
        case "copy a record":
            records.append(dict(record))
        case "add a field":
            record["colour"] = draw
        case "name the own hotel":
            record["hotel_id"] = hotel
        case "shuffle":
            records.reverse()
        case "another count":
            record["available"] = draw
        case "drop a record":
            records.remove(record)
        case "drop a hotel's records":
            records.clear()
        case "copy with another count":
            records.append({**record, "available": record["available"] + 1 + draw})
        case "name another hotel":
            record["hotel_id"] = f"{hotel}{draw}"
        case "an unknown room":
            record["room_type_id"] += "x"
        case "a day after the last":
            record["date"] = (END + timedelta(days=1 + draw % 900)).isoformat()
        case "a day before the first":
            record["date"] = (START - timedelta(days=1 + draw % 900)).isoformat()
        case "a day that does not exist":
            record["date"] = record["date"][:5] + "04-31"
        case "a count as text":
            record["available"] = str(draw)
        case "a fraction":
            record["available"] = draw + 0.5
        case "below zero":
            record["available"] = -1 - draw


@RELAXED
@given(
    st.sampled_from(sorted(EDITS)), st.sampled_from([hotel for hotel, _ in HOTELS]),
    st.integers(0, 5), st.integers(0, 2**62), st.integers(1, 7),
)
def test_one_edit_of_a_complete_batch_has_its_known_effect(spark, edit, hotel, at, draw, page_size):
    payloads = items()
    _edited(edit, payloads, hotel, at, draw)
    kept = {
        (name, r["room_type_id"], date.fromisoformat(r["date"])): r["available"]
        for name, records in payloads.items() for r in records
    } if EDITS[edit] is None else None
    try:
        snapshot = collect_snapshot(
            pages(spark, payloads, page_size), hotels(spark),
            start_date=START, horizon_days=3, snapshot_at=STAMP,
        )
    except SnapshotError as refusal:
        assert refusal.reason == EDITS[edit]
    else:
        rows = snapshot.rows.collect()
        assert {(r.hotel_id, r.room_type_id, r.stay_date): r.available_rooms for r in rows} == kept
        assert len(rows) == 9
        snapshot.close()


def _walk(landed, limits):
    """Follow one hotel's pages in order, as the caller of the API did."""
    asked, seen = None, set()
    ordered = sorted(landed, key=lambda p: p[1])
    if len({p[1] for p in ordered}) < len(ordered):
        return False
    if [p[1] for p in ordered] != list(range(ordered[0][1], ordered[0][1] + len(ordered))):
        return False
    if len(ordered) > limits.max_pages:
        return False
    for position, (_, _, request, body) in enumerate(ordered):
        if request != asked:
            return False
        following = json.loads(body)["next_cursor"]
        if following is None:
            return position == len(ordered) - 1
        if following in seen:
            return False
        seen.add(following)
        asked = following
    return False


CURSOR = st.sampled_from([None, "a", "b", "c"])


@RELAXED
@given(
    st.lists(st.tuples(st.integers(1, 4), CURSOR, CURSOR), min_size=1, max_size=4),
    st.booleans(),
)
def test_chain_agrees_with_a_walk(spark, raw, repair):
    if repair:  # otherwise a sound chain would hardly ever be drawn
        cursors = [None, *(c for c in dict.fromkeys(g for _, _, g in raw) if c)]
        raw = [
            (n + 1, cursor, cursors[n + 1] if n + 1 < len(cursors) else None)
            for n, cursor in enumerate(cursors)
        ]
    landed = [("h", seq, asked, page([], given)) for seq, asked, given in raw]
    limits = Limits(max_pages=3)
    frame = spark.createDataFrame(landed, PAGE_SCHEMA)
    verdict = P.page_chain(
        P.page_headers(P.decode_pages(frame)), hotels(spark, [("h", ["r"])]), limits
    ).first()
    assert (verdict.chain_rule is None) == _walk(landed, limits)
