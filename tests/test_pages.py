import json
from datetime import date

import pytest

from samples import hotels, listed, page, pages
from staytally import SnapshotError
from staytally.functions import strict_json as J
from staytally.plans.acceptance import synthetic_pages
from staytally.operators.ranking import number_rows
from staytally.schema import PAGE_SCHEMA, Limits
from staytally.sources import pages as P
from staytally.workspace import Workspace

EMPTY = '{"items": [], "next_cursor": null}'


def _decode(spark, body, limits=Limits(max_cursor_chars=4_096)):
    landed = spark.createDataFrame([("h", 1, None, body)], PAGE_SCHEMA)
    return P.decode_pages(landed, limits).first()


def _variants():
    """One sound page, and per rule what breaks it: each field absent, null, or of another type."""
    sound = {"items": [{"room_type_id": "r"}], "next_cursor": "n1"}
    text = json.dumps(sound)
    yield text, None
    yield json.dumps({**sound, "next_cursor": None, "trace": {"ms": 3}}), None
    yield json.dumps({**sound, "next_cursor": "n" * 4096}), None
    yield json.dumps({**sound, "next_cursor": "n" * 4097}), "bad_cursor"
    for field in sound:
        yield json.dumps({k: v for k, v in sound.items() if k != field}), "no_items"
    others = {"items": (None, "r", 7, {}, [None], ["r"], [{}, 7], [[{}]]), "next_cursor": ("", 7, True, [], {})}
    for field, values in others.items():
        rule = "bad_items" if field == "items" else "bad_cursor"
        yield from ((json.dumps({**sound, field: value}), rule) for value in values)
    yield from ((json.dumps(value), "not_object") for value in (None, True, 7, "page", [sound]))
    yield from ((text[:cut], "not_json") for cut in (0, 1, len(text) // 2, len(text) - 1))
    yield from ((text + tail, "not_json") for tail in ("]", ",", text, " null"))
    yield text.replace('"r"', "Infinity"), "not_json"
    yield text.replace("{", '{"next_cursor": "n0", ', 1), "not_json"
    yield text.replace('{"room', '{"room_type_id": "q", "room'), "not_json"
    yield None, "not_json"


@pytest.mark.parametrize("body,rule", list(_variants()))
def test_page_rules(spark, body, rule):
    decoded = _decode(spark, body)
    assert decoded.page_rule == rule
    if rule:
        assert decoded["items"] == []


def test_body_size_boundary(spark):
    assert _decode(spark, EMPTY, Limits(max_response_bytes=len(EMPTY))).page_rule is None
    assert _decode(spark, EMPTY, Limits(max_response_bytes=len(EMPTY) - 1)).page_rule == "too_large"
    wide = page([{"x": "é"}])
    wide = json.dumps(json.loads(wide), ensure_ascii=False)
    assert _decode(spark, wide, Limits(max_response_bytes=len(wide))).page_rule == "too_large"


def test_absent_and_null_fields_are_told_apart(spark):
    landed = spark.createDataFrame(
        [("h", 1, None, page([{"hotel_id": None}, {}, {"hotel_id": "h"}]))], PAGE_SCHEMA
    )
    exploded = P.explode_pages(P.decode_pages(landed))
    absent = exploded.select("pos", J.is_absent("item.hotel_id").alias("absent")).collect()
    assert [(r.pos, r.absent) for r in sorted(absent)] == [(0, False), (1, True), (2, False)]


def _chain(spark, landed, wanted=("h",), limits=Limits()):
    frame = spark.createDataFrame(landed, PAGE_SCHEMA)
    expected = hotels(spark, [(hotel, ["r"]) for hotel in wanted])
    verdicts = P.page_chain(P.page_headers(P.decode_pages(frame, limits)), expected, limits)
    return {r.hotel_id: r.chain_rule for r in verdicts.collect()}


def test_chain_verdicts(spark):
    one = page([], None)
    good = [("h", 1, None, page([], "a")), ("h", 2, "a", page([], "b")), ("h", 3, "b", one)]
    assert _chain(spark, good) == {"h": None}
    assert _chain(spark, [("h", 5, None, one)]) == {"h": None}
    assert _chain(spark, good[:2]) == {"h": "broken_chain"}  # no final null
    assert _chain(spark, good[1:]) == {"h": "broken_chain"}  # no first page
    assert _chain(spark, [good[0], good[2]]) == {"h": "broken_chain"}  # a gap
    assert _chain(spark, [good[0], ("h", 2, "x", one)]) == {"h": "broken_chain"}
    assert _chain(spark, [("h", 1, None, one), ("h", 2, None, one)]) == {"h": "broken_chain"}
    assert _chain(spark, [("h", 1, "a", one)]) == {"h": "broken_chain"}
    assert _chain(spark, [*good, good[0]]) == {"h": "repeated_page"}
    looped = [good[0], ("h", 2, "a", page([], "a")), ("h", 3, "a", one)]
    assert _chain(spark, looped) == {"h": "repeated_cursor"}
    assert _chain(spark, good, ("h", "other")) == {"h": None, "other": "no_pages"}
    assert _chain(spark, good, ("other",)) == {"h": "unrequested_hotel", "other": "no_pages"}


def test_page_and_record_limits(spark):
    two = [("h", 1, None, page([{}, {}], "a")), ("h", 2, "a", page([{}], None))]
    assert _chain(spark, two, limits=Limits(max_pages=1)) == {"h": "page_limit"}
    assert _chain(spark, two, limits=Limits(max_items=2)) == {"h": "record_limit"}
    assert _chain(spark, two, limits=Limits(max_items=3, max_pages=2)) == {"h": None}


def test_golden_pages(spark):
    entries = [("DEMO_NORTH", ["single", "double", "suite"]),
               ("DEMO_SOUTH", ["single", "double", "suite"])]
    day = date(2026, 9, 27)
    landed = synthetic_pages(hotels(spark, entries), day, 2, day, page_size=2)
    north = sorted(landed.where("hotel_id = 'DEMO_NORTH'").collect())
    read = [(r.page_seq, r.request_cursor, json.loads(r.body)) for r in north]
    assert [(seq, cursor, body["next_cursor"]) for seq, cursor, body in read] == [
        (1, None, "2"), (2, "2", "4"), (3, "4", None)
    ]
    assert [
        (i["room_type_id"], i["date"], i["available"]) for _, _, b in read for i in b["items"]
    ] == [
        ("single", "2026-09-27", 1), ("single", "2026-09-28", 2), ("double", "2026-09-27", 6),
        ("double", "2026-09-28", 7), ("suite", "2026-09-27", 9), ("suite", "2026-09-28", 10),
    ]
    zero = date(2026, 9, 30)
    body = synthetic_pages(hotels(spark, entries[:1]), zero, 1, day).first().body
    assert [i["available"] for i in json.loads(body)["items"]] == [4, 9, 0]
    south = synthetic_pages(hotels(spark, entries[1:]), day, 1, day).first().body
    assert [i["available"] for i in json.loads(south)["items"]] == [9, 2, 5]


def test_default_paging_of_the_longest_range(spark):
    day = date(2026, 9, 27)
    landed = synthetic_pages(hotels(spark, [("h", ["a", "b", "c"])]), day, 366, day)
    headers = P.page_headers(P.decode_pages(landed)).collect()
    assert sorted((r.page_seq, r.records) for r in headers) == [
        *((n, 128) for n in range(1, 9)), (9, 74)
    ]


def test_cursors_of_a_custom_page_size(spark):
    entries = [("Custom.Hotel-7", ["z-room", "a_room"])]
    day = date(2026, 9, 27)
    landed = synthetic_pages(hotels(spark, entries), day, 12, day, page_size=5).collect()
    assert [r.request_cursor for r in sorted(landed)] == [None, "5", "10", "15", "20"]
    assert len(json.loads(sorted(landed)[-1].body)["items"]) == 4


def test_numbering_spans_ranges_and_skewed_groups(spark):
    """One group holds most rows, so it is cut across many ranges."""
    rows = spark.range(4000).selectExpr(
        "if(id % 10 < 7, 'hot', concat('g', id % 10)) AS g", "id * 7919 % 4001 AS v"
    )
    got = number_rows(rows, "g", ["v"], Workspace(spark)).collect()
    for name in {r.g for r in got}:
        group = sorted((r.v, r.position, r.total) for r in got if r.g == name)
        assert [p for _, p, _ in group] == list(range(len(group)))
        assert {t for _, _, t in group} == {len(group)}


def test_page_table_and_raw_file_layouts(spark, tmp_path):
    payload = {"007": [{"room_type_id": "a", "date": "2026-01-01", "available": 1}] * 3}
    landed = pages(spark, payload)
    landed.write.parquet(str(tmp_path / "table"))
    landed.write.json(str(tmp_path / "lines"))
    landed.write.partitionBy("hotel_id", "page_seq", "request_cursor").text(str(tmp_path / "raw"))
    expected = listed(landed)
    assert listed(P.read_pages(spark, str(tmp_path / "table"))) == expected
    assert listed(P.read_pages(spark, str(tmp_path / "lines"), "json")) == expected
    raw = P.read_page_files(spark, str(tmp_path / "raw")).collect()
    assert sorted((r.hotel_id, r.page_seq, r.request_cursor, r.body.strip()) for r in raw) == sorted(
        expected, key=lambda r: r[1]
    )


def test_bodies_that_are_not_utf8_are_refused_and_not_repaired(spark, tmp_path):
    for seq, tail in ((1, b""), (2, b"\xff"), (3, "é".encode("latin-1"))):
        folder = tmp_path / "raw" / "hotel_id=h" / f"page_seq={seq}" / f"request_cursor=c{seq}"
        folder.mkdir(parents=True)
        (folder / "body").write_bytes(b'{"items": [], "next_cursor": "' + b"a" + tail + b'"}')
    decoded = P.decode_pages(P.read_page_files(spark, str(tmp_path / "raw")))
    assert {r.page_seq: r.page_rule for r in decoded.collect()} == {1: None, 2: "not_json", 3: "not_json"}


def test_page_files_keep_any_identifier_and_every_page(spark, tmp_path):
    names = ["007", "a b", "%", "%41", "a%2Fb", "x/y:z=?*[{^]}", "é\u20ac", "..", "__", "", None, "%E9", "\t\"\\#'"]
    rows = [(name, seq, cursor, f"{n} {seq}") for n, name in enumerate(names) for seq, cursor in ((1, None), (2, "c/1"), (2, "+%"))]
    rows += [("twin", 1, None, "same"), ("twin", 1, None, "same"), ("twin", 1, None, None)]
    landed = spark.createDataFrame(rows, "hotel_id string, page_seq bigint, request_cursor string, body string")
    P.write_page_files(landed, str(tmp_path / "raw"))
    raw = [(r.hotel_id, r.page_seq, r.request_cursor, r.body) for r in P.read_page_files(spark, str(tmp_path / "raw")).collect()]
    # Spark's folder names do not tell an empty value from none.
    wanted = [(name or None, seq, cursor, f"{body or ''}\n") for name, seq, cursor, body in rows]
    assert sorted(raw, key=str) == sorted(wanted, key=str)
    # Spark itself reads the same values from these folders.
    inferred = spark.read.schema("value string, hotel_id string, page_seq bigint, request_cursor string").text(str(tmp_path / "raw"))
    told = {(r.hotel_id, r.page_seq, r.request_cursor) for r in inferred.collect()}
    assert told == {row[:3] for row in wanted}
    with pytest.raises(SnapshotError):
        P.write_page_files(landed, str(tmp_path / "raw"))


def test_page_files_of_spark_itself_are_read_alike(spark, tmp_path):
    rows = [(name, 1, name, "b") for name in ["a b", "%41", "x/y:z=?*[{^]}", "é", "+"]]
    landed = spark.createDataFrame(rows, "hotel_id string, page_seq bigint, request_cursor string, body string")
    landed.write.partitionBy("hotel_id", "page_seq", "request_cursor").text(str(tmp_path / "raw"))
    read = P.read_page_files(spark, str(tmp_path / "raw"))
    assert sorted((r.hotel_id, r.page_seq, r.request_cursor, r.body.strip()) for r in read.collect()) == sorted(rows)


def test_page_files_are_renamed_and_listed_by_few_tasks(spark, tmp_path):
    """Before, Spark staged and renamed a folder per page, listed with a task per folder, and inferred a partition per page."""
    rows = [(f"h{n}", 1, None, "{}") for n in range(200)]
    landed = spark.createDataFrame(rows, "hotel_id string, page_seq bigint, request_cursor string, body string")
    P.write_page_files(landed, str(tmp_path / "raw"))
    assert not list((tmp_path / "raw").glob("**/.*"))
    spark.sparkContext.setJobGroup("listing", "")
    try:
        read = P.read_page_files(spark, str(tmp_path / "raw"))
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
        assert max(s.numTasks for s in stages if s) <= 4 * spark.sparkContext.defaultParallelism
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert read.count() == 200


def test_no_page_files_are_written_and_read(spark, tmp_path):
    nothing = spark.createDataFrame([], "hotel_id string, page_seq bigint, request_cursor string, body string")
    P.write_page_files(nothing, str(tmp_path / "raw"))
    assert P.read_page_files(spark, str(tmp_path / "raw")).collect() == []
