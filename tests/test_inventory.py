import json

import pytest

from samples import hotels, listed
from staytally import SnapshotError, fs
from staytally.sources import inventory as I

ENTRIES = [
    {"hotel_id": "quay-9", "room_type_ids": ["loft", "cabin"]},
    {"hotel_id": "mill.2", "room_type_ids": ["barn"]},
]


def _read(spark, tmp_path, text):
    path = tmp_path / "inventory.json"
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return I.read_hotels(spark, str(path))


def test_configuration_is_read_whatever_its_layout(spark, tmp_path):
    turned = [dict(reversed(entry.items())) for entry in ENTRIES]
    for text in (json.dumps({"hotels": ENTRIES}), json.dumps({"hotels": turned}, indent=3) + "\n"):
        read = _read(spark, tmp_path, text)
        assert listed(read) == sorted((e["hotel_id"], e["room_type_ids"]) for e in ENTRIES)
        assert I.require_sound(read) == 3
        assert listed(I.expected_rooms(read)) == [("mill.2", "barn"), ("quay-9", "cabin"), ("quay-9", "loft")]


def test_configuration_is_read_once(spark, tmp_path):
    read = _read(spark, tmp_path, json.dumps({"hotels": ENTRIES}))
    fs.delete(spark, str(tmp_path / "inventory.json"))
    assert read.count() == 2


def _refused():
    """Every way in which the document can differ from one array of exact entries."""
    for value in (None, True, 4, "quay-9", ENTRIES, {}):
        yield json.dumps(value)
    for value in (None, "quay-9", 4, [], {}, [[]], [7], [None], ENTRIES[0]):
        yield json.dumps({"hotels": value})
    yield json.dumps({"hotels": ENTRIES, "version": 1})
    for field in ENTRIES[0]:
        kept = {k: v for k, v in ENTRIES[0].items() if k != field}
        yield json.dumps({"hotels": [ENTRIES[1], kept]})
        for value in (None, 4, True, {}):
            yield json.dumps({"hotels": [ENTRIES[1], {**ENTRIES[0], field: value}]})
    yield json.dumps({"hotels": [{**ENTRIES[0], "stars": 5}]})
    text = json.dumps({"hotels": ENTRIES})
    yield from (text[:-1], text + text, text.replace("{", '{"hotels": [], ', 1), text.encode("utf-16"))
    yield text.replace('"barn"', "-Infinity")


@pytest.mark.parametrize("text", list(_refused()))
def test_other_configurations_are_refused(spark, tmp_path, text):
    with pytest.raises(SnapshotError) as error:
        _read(spark, tmp_path, text)
    assert error.value.reason == "bad_inventory"


def test_rooms_of_other_types_are_unsound(spark, tmp_path):
    for value in (None, 4, ["loft"]):
        text = json.dumps({"hotels": [{**ENTRIES[0], "room_type_ids": ["loft", value]}]})
        with pytest.raises(SnapshotError, match="bad_room_id"):
            I.require_sound(_read(spark, tmp_path, text))


def _unsound():
    good = ("quay-9", ["loft", "cabin"])
    yield [], "no hotels"
    yield [good, ("mill.2", ["barn"]), good], "repeated_hotel"
    for name in ("", "quay 9", "-quay", "q" * 129, None):
        yield [good, (name, ["barn"])], "bad_hotel_id"
        yield [good, ("mill.2", ["barn", name])], "bad_room_id"
    for rooms in ([], None):
        yield [good, ("mill.2", rooms)], "no_rooms"
    yield [good, ("mill.2", ["barn", "loft", "barn"])], "repeated_room"


@pytest.mark.parametrize("entries,fault", list(_unsound()))
def test_unsound_inventories(spark, entries, fault):
    with pytest.raises(SnapshotError, match=fault):
        I.require_sound(hotels(spark, entries))


def test_a_row_carries_the_first_fault_it_has(spark):
    entries = [("bad id", []), ("mill.2", []), ("quay-9", ["x y", "x y"]), ("pier", ["a", "a"]), ("pier", ["b"])]
    found = {r.hotel_id: r.fault for r in I.hotel_faults(hotels(spark, entries)).collect()}
    assert found == {
        "bad id": "bad_hotel_id", "mill.2": "no_rooms", "quay-9": "bad_room_id", "pier": "repeated_room",
    }


ODD = [
    {"hotel_id": 'a"}],[{\\', "room_type_ids": ["}", "{", "\\", " ü"]},
    {"hotel_id": "b", "room_type_ids": []},
    {"hotel_id": "b", "room_type_ids": [None, {"x": [{}]}, "r"]},
]


def test_a_document_is_read_whatever_its_lines_and_texts(spark, tmp_path):
    wanted = sorted((e["hotel_id"], [r if isinstance(r, str) else None for r in e["room_type_ids"]]) for e in ODD)
    for text in (json.dumps({"hotels": ODD}), json.dumps({"hotels": ODD}, indent=1, ensure_ascii=False).replace("\n", "\r\n\t")):
        read = _read(spark, tmp_path, text)
        assert sorted(((r.hotel_id, r.room_type_ids) for r in read.collect()), key=str) == sorted(wanted, key=str)


def test_an_inventory_of_one_long_line_is_not_carried_with_every_entry(spark, tmp_path):
    """Before, every entry's row held the list of all: 12,000 entries took more than 6 GB."""
    entries = [{"hotel_id": f"h{n}", "room_type_ids": ["single", "double", "suite"]} for n in range(12_000)]
    read = _read(spark, tmp_path, json.dumps({"hotels": entries}))
    assert sorted(r.hotel_id for r in read.collect()) == sorted(e["hotel_id"] for e in entries)


def test_an_inventory_is_written_in_parts_and_read_as_one_document(spark, tmp_path):
    entries = [(f"h{n % 2_000}", ["single", 'a"}']) for n in range(9_000)]
    merged = "spark.sql.adaptive.coalescePartitions.enabled"  # else so little text is one part
    spark.conf.set(merged, "false")
    try:
        I.write_hotels(spark.createDataFrame(entries, "hotel_id string, room_type_ids array<string>"), str(tmp_path / "parts"))
    finally:
        spark.conf.unset(merged)
    files = sorted((tmp_path / "parts").glob("part-*"))
    assert len(files) > 1
    document = json.loads("".join(file.read_text() for file in files))
    told = [(e["hotel_id"], e["room_type_ids"]) for e in document["hotels"]]
    assert list(document) == ["hotels"] and told == sorted(entries)
    assert listed(I.read_hotels(spark, str(tmp_path / "parts"), parts=True)) == sorted(entries)
    with pytest.raises(SnapshotError):  # each of them alone is no document
        I.read_hotels(spark, str(tmp_path / "parts"))
    files[-1].unlink()
    with pytest.raises(SnapshotError):
        I.read_hotels(spark, str(tmp_path / "parts"), parts=True)


def test_an_empty_inventory_is_refused_in_parts_too(spark, tmp_path):
    nothing = spark.createDataFrame([], "hotel_id string, room_type_ids array<string>")
    I.write_hotels(nothing, str(tmp_path / "parts"))
    with pytest.raises(SnapshotError):
        I.read_hotels(spark, str(tmp_path / "parts"), parts=True)


def test_every_file_is_a_document(spark, tmp_path):
    for name, entry in zip("ab", ENTRIES, strict=True):
        (tmp_path / f"{name}.json").write_text(json.dumps({"hotels": [entry]}))
    assert listed(I.read_hotels(spark, str(tmp_path))) == sorted((e["hotel_id"], e["room_type_ids"]) for e in ENTRIES)
    (tmp_path / "c.json").write_text("")
    with pytest.raises(SnapshotError):
        I.read_hotels(spark, str(tmp_path))


ONE = '{"hotel_id": "a", "room_type_ids": ["r"]}'


@pytest.mark.parametrize(
    "text",
    [
        f'{{"hotels": [{ONE}]',
        f'{{"hotels": [{ONE}',
        f'{{"hotels": [{ONE} {ONE}]}}',
        f'{{"hotels": [{ONE},]}}',
        f'{{"hotels": [,{ONE}]}}',
        f'{{"hotels": [{ONE},,{ONE}]}}',
        f'{{"hotels": [{ONE}, 1]}}',
        f'{{"hotels": [1, {ONE}]}}',
        f'{{"hotels": [{ONE}]}} {{"hotels": [{ONE}]}}',
        f'{{"hotels": [{ONE}], "hotels": [{ONE}]}}',
        f'{{"hotels": [{ONE}, 1], "hotels": [{ONE}]}}',
        f'{{"hotels": [{ONE}}}]',
        f'{{"hotels": [{ONE}]}}{{',
        f'{{"hotels": [{ONE}]}}"',
        f'{{"hotels": [{ONE}, {{"hotel_id": "b", "room_type_ids": [tr\nue]}}]}}',
        f'{{"hotels": [{ONE}, {{"hotel_id": "b\n", "room_type_ids": []}}]}}',
        f'{{"hotels": [{ONE}, {{"hotel_id": "b", "room_type_ids": ["\\}}"]}}]}}',
        f'{{"hotels": [{ONE}]}}'.encode().replace(b'"a"', b'"\xff"'),
    ],
)
def test_a_list_that_breaks_between_entries_is_refused(spark, tmp_path, text):
    with pytest.raises(SnapshotError):
        _read(spark, tmp_path, text)
