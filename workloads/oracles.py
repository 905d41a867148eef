"""The same queries in plain SQL for DuckDB, over the same tables."""

from __future__ import annotations

OBS = """
    SELECT 'H' || user_id AS hotel_id, event_type AS room_type_id,
           CAST(ts AS DATE) + 1 + CAST(event_id % 2 AS INT) AS stay_date,
           CAST(floor(value) AS BIGINT) AS available_rooms,
           CAST(ts AS DATE) AS snapshot_date, ts AS observed_at
    FROM events"""

LINES = """
    SELECT 'S' || l_suppkey AS hotel_id, 'P' || (l_partkey % 3) AS room_type_id,
           CAST(l_shipdate AS DATE) AS stay_date, CAST(l_quantity AS BIGINT) AS available_rooms,
           CAST(o_orderdate AS DATE) AS snapshot_date,
           o_orderdate + l_linenumber * INTERVAL 1 HOUR AS observed_at
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""

ROOMS = """
    SELECT DISTINCT 'H' || user_id AS hotel_id, event_type AS room_type_id
    FROM events WHERE event_type <> 'error'"""

RECORDS = """
    SELECT *, CASE
        WHEN event_id % 19 IN (1, 2) THEN 'wrong_hotel'
        WHEN event_id % 11 = 3 OR event_type = 'error' THEN 'unknown_room'
        WHEN event_id % 13 IN (5, 7, 9) THEN 'bad_date'
        WHEN CAST(ts AS DATE) NOT BETWEEN DATE '2024-01-06' AND DATE '2024-01-25'
            THEN 'out_of_range'
        WHEN event_id % 17 IN (2, 4, 6, 10, 12) THEN 'not_integer'
        WHEN event_id % 17 = 8 THEN 'negative' END AS rule
    FROM events"""

GRID_DAYS = "(SELECT DATE '2024-01-06' + CAST(range AS INT) AS stay_date FROM range(20)) d"

IN_RANGE = "stay_date BETWEEN DATE '2024-01-06' AND DATE '2024-01-25'"

KEY = "hotel_id, room_type_id, snapshot_date, stay_date"

SUPPLIER_ROOMS = """
    SELECT 'S' || s_suppkey AS hotel_id, room_type_id, room_no
    FROM supplier, (VALUES ('single', 0), ('double', 1), ('suite', 2)) r(room_type_id, room_no)"""


def _time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'"


def _key(prefix: str = "") -> str:
    return (
        f"{prefix}hotel_id AS hotel_id, {prefix}room_type_id AS room_type_id, "
        f"CAST({prefix}snapshot_date AS VARCHAR) AS snapshot_date, "
        f"CAST({prefix}stay_date AS VARCHAR) AS stay_date"
    )


def _latest(source: str) -> str:
    return f"""
        SELECT {KEY}, arg_max(available_rooms, observed_at) AS available_rooms,
               max(observed_at) AS observed_at
        FROM ({source}) GROUP BY {KEY}"""


MORNING = _latest(f"SELECT * FROM ({OBS}) WHERE hour(observed_at) < 12")
DAYTIME = _latest(f"SELECT * FROM ({OBS}) WHERE hour(observed_at) >= 6")


def _states(target: str, incoming: str) -> str:
    return f"""
        SELECT {KEY},
               count(*) FILTER (t) AS nt, count(*) FILTER (NOT t) AS ns,
               max(available_rooms) FILTER (t) AS tv, max(observed_at) FILTER (t) AS tt,
               max(available_rooms) FILTER (NOT t) AS sv, max(observed_at) FILTER (NOT t) AS st
        FROM (SELECT {KEY}, available_rooms, observed_at, true AS t FROM ({target})
              UNION ALL
              SELECT {KEY}, available_rooms, observed_at, false FROM ({incoming}))
        GROUP BY {KEY}"""


DECISION = """CASE
    WHEN ns > 1 THEN 'duplicate_in_batch' WHEN nt > 1 THEN 'duplicate_in_table'
    WHEN ns = 0 THEN 'keep' WHEN nt = 0 THEN 'insert'
    WHEN st > tt THEN 'update' WHEN st < tt THEN 'stale'
    WHEN sv <> tv THEN 'conflict' ELSE 'replay' END"""


def _merge(target: str, incoming: str) -> str:
    wins = "(ns = 1 AND (nt = 0 OR st > tt))"
    return f"""
        SELECT {_key()}, CASE WHEN {wins} THEN sv ELSE tv END AS available_rooms,
               {_time(f"CASE WHEN {wins} THEN st ELSE tt END")} AS observed_at,
               {DECISION} AS decision
        FROM ({_states(target, incoming)})"""


def _decisions(target: str, incoming: str) -> str:
    return f"""
        SELECT {DECISION} AS decision, count(*) AS keys
        FROM ({_states(target, incoming)}) GROUP BY 1"""


def _same_day(source: str) -> str:
    return f"""
        SELECT {KEY}, available_rooms, CAST(snapshot_date AS TIMESTAMP) AS observed_at
        FROM ({source})"""


def _written(step: int, target: str, batch: str) -> str:
    """Counts of one write: the batch against the table's days that it touches."""
    touched = f"SELECT snapshot_date FROM ({batch})"
    pruned = f"SELECT * FROM ({target}) WHERE snapshot_date IN ({touched})"
    names = {
        "insert": "inserted", "update": "updated", "replay": "replayed",
        "stale": "stale", "keep": "kept",
    }
    counts = ", ".join(
        f"count(*) FILTER (decision = '{name}') AS {column}" for name, column in names.items()
    )
    return f"""
        SELECT CAST({step} AS BIGINT) AS step,
               CASE WHEN bool_or(decision IN ('insert', 'update')) THEN 'changed'
                    ELSE 'unchanged' END AS outcome, {counts}
        FROM (SELECT {DECISION} AS decision FROM ({_states(pruned, batch)}))"""


BOTH = f"SELECT * FROM ({MORNING}) UNION ALL SELECT * FROM ({DAYTIME})"
NOTHING = f"SELECT * FROM ({MORNING}) WHERE false"

IDENTIFIER = "'[A-Za-z0-9][A-Za-z0-9_.-]{0,127}'"

_TEXT_FIELDS = [
    ("orders", "o_orderpriority"),
    ("supplier", "s_name"),
    ("customer", "c_name"),
    ("customer", "c_mktsegment"),
    ("part", "p_name"),
    ("part", "p_brand"),
    ("documents", "text"),
    ("pages", "url"),
]

_OBS_TALLY = f"""
    SELECT coalesce(r.hotel_id, o.hotel_id) AS hotel_id,
           coalesce(r.room_type_id, o.room_type_id) AS room_type_id,
           CASE WHEN r.hotel_id IS NULL THEN 0 ELSE 1 END AS expected,
           coalesce(records, 0) AS records,
           CASE WHEN r.hotel_id IS NULL THEN 0 ELSE coalesce(cells, 0) END AS cells,
           CASE WHEN r.hotel_id IS NULL THEN 0 ELSE coalesce(conflicts, 0) END AS conflicts
    FROM ({ROOMS}) r FULL JOIN (
        SELECT hotel_id, room_type_id, sum(n) AS records, count(*) AS cells,
               count(*) FILTER (low <> high) AS conflicts
        FROM (SELECT hotel_id, room_type_id, stay_date, min(available_rooms) AS low,
                     max(available_rooms) AS high, count(*) AS n
              FROM ({OBS}) WHERE {IN_RANGE} GROUP BY 1, 2, 3)
        GROUP BY 1, 2) o
    ON r.hotel_id = o.hotel_id AND r.room_type_id = o.room_type_id"""

_GATE_COUNTS = f"""
    WITH records AS ({RECORDS}),
    hotels AS (SELECT user_id, count(*) AS n, count(*) FILTER (event_type <> 'error') AS known
               FROM events GROUP BY 1),
    cells AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day,
                     min(floor(value)) <> max(floor(value)) AS differs
              FROM records WHERE rule IS NULL GROUP BY 1, 2, 3),
    wanted AS (SELECT count(*) * 20 AS n FROM ({ROOMS}))
"""

_NO_FAILURES = [
    "too_large", "not_json", "not_object", "no_items", "bad_items", "bad_cursor", "no_pages",
    "repeated_page", "repeated_cursor", "broken_chain", "record_limit",
]
_RULES = [
    "wrong_hotel", "unknown_room", "bad_date", "out_of_range", "not_integer", "negative",
]

_GATE = "\nUNION ALL ".join(
    [f"SELECT '{name}' AS \"check\", CAST(0 AS BIGINT) AS failures" for name in _NO_FAILURES]
    + [
        "SELECT 'unrequested_hotel', count(*) FILTER (known = 0) FROM hotels",
        "SELECT 'page_limit', count(*) FILTER (known > 0 AND n > 50) FROM hotels",
        "SELECT 'row_limit', greatest(count(*) - 5000, 0) FROM records",
        "SELECT 'conflict', count(*) FILTER (differs) FROM cells",
        "SELECT 'incomplete', any_value(n) - (SELECT count(*) FROM cells) FROM wanted",
    ]
    + [f"SELECT '{name}', count(*) FILTER (rule = '{name}') FROM records" for name in _RULES]
)

_LINE_COUNTS = "SELECT l_suppkey AS h, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1"

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

_DEFECTS = {
    "too_large": {1: 1},
    "not_json": {2: 1},
    "not_object": {3: 1},
    "no_items": {4: 1},
    "bad_items": {5: 1},
    "bad_cursor": {6: 1},
    "unrequested_hotel": {7: 1},
    "no_pages": {8: 1},
    "repeated_page": {9: 1},
    "repeated_cursor": {10: 1},
    "broken_chain": {11: 1},
    "page_limit": {12: 1},
    "record_limit": {13: 1},
    "wrong_hotel": {14: 1},
    "unknown_room": {14: 1},
    "bad_date": {14: 1},
    "out_of_range": {14: 1},
    "not_integer": {14: 1},
    "negative": {14: 1},
    "conflict": {15: 1},
    # Two cells are wanted of every requested hotel; these kinds bring none.
    "incomplete": {kind: 2 for kind in (1, 2, 3, 4, 5, 6, 8, 14)},
}

ORACLES: dict[str, str] = {
    "paginate_table": f"""
        SELECT 'S' || h AS hotel_id, CAST(i + 1 AS INT) AS page_seq,
               CASE WHEN i > 0 THEN CAST(i * 128 AS VARCHAR) END AS request_cursor,
               CASE WHEN (i + 1) * 128 < n THEN CAST((i + 1) * 128 AS VARCHAR) END AS next_cursor,
               CAST(least(128, n - i * 128) AS BIGINT) AS records
        FROM (SELECT h, n, unnest(range((n + 127) // 128)) AS i FROM ({_LINE_COUNTS}))""",
    "pages_roundtrip": f"""
        SELECT hotel_id, room_type_id, CAST(stay_date AS VARCHAR) AS stay_date, available_rooms
        FROM ({LINES})""",
    "page_items": """
        SELECT 'H' || user_id AS hotel_id,
               row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS position,
               CASE WHEN event_id % 11 = 3 THEN 'attic' ELSE event_type END AS room_type_id
        FROM events""",
    "page_chain_report": f"""
        SELECT 'S' || coalesce(s_suppkey, h) AS hotel_id, coalesce(p, 0) AS pages,
               coalesce(n, 0) AS records,
               CAST(CASE WHEN p IS NULL THEN 0 ELSE 1 END AS BIGINT) AS starts,
               CAST(0 AS BIGINT) AS repeated_pages,
               CAST(CASE WHEN h % 5 = 2 AND p > 1 THEN 1 ELSE 0 END AS BIGINT) AS repeated_cursors,
               CAST(CASE WHEN h % 5 IN (1, 2) AND p > 1 THEN 1 WHEN h % 5 = 3 THEN 1 ELSE 0 END
                   AS BIGINT) AS broken_links,
               CASE WHEN s_suppkey IS NULL THEN 'unrequested_hotel' WHEN p IS NULL THEN 'no_pages'
                    WHEN h % 5 = 2 AND p > 1 THEN 'repeated_cursor'
                    WHEN h % 5 = 3 OR (h % 5 = 1 AND p > 1) THEN 'broken_chain' END AS chain_rule
        FROM supplier FULL JOIN (SELECT h, n, (n + 127) // 128 AS p FROM ({_LINE_COUNTS}))
        ON s_suppkey = h""",
    "volume_limits": """
        SELECT 'H' || user_id AS hotel_id, (count(*) + 9) // 10 AS pages, count(*) AS records,
               CASE WHEN count(*) > 90 THEN 'page_limit' WHEN count(*) > 70 THEN 'record_limit' END
                   AS chain_rule
        FROM events GROUP BY user_id""",
    "page_shape_report": """
        SELECT CASE WHEN event_id % 12 IN (1, 2) THEN 'not_object' WHEN event_id % 12 = 3 THEN 'no_items'
                    WHEN event_id % 12 IN (4, 5) THEN 'bad_items'
                    WHEN event_id % 12 IN (6, 7, 11) THEN 'bad_cursor'
                    WHEN event_id % 12 IN (8, 9, 10) THEN 'not_json' END AS page_rule,
               count(*) AS pages, count(*) FILTER (event_id % 12 = 0) AS accepted_items
        FROM events GROUP BY 1""",
    "props_strict": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "strict_json_verdicts": "SELECT event_id, event_id % 8 IN (0, 7) AS accepted FROM events",
    "document_bodies": "SELECT doc_id, length(text) AS chars, true AS same FROM documents",
    "inventory_faults": """
        SELECT hotel_id, count(*) AS entries, CAST(sum(rooms) AS BIGINT) AS rooms,
               CASE coalesce(min(fault), CASE WHEN count(*) > 1 THEN 4 END)
                   WHEN 0 THEN 'bad_hotel_id' WHEN 1 THEN 'no_rooms' WHEN 2 THEN 'bad_room_id'
                   WHEN 3 THEN 'repeated_room' WHEN 4 THEN 'repeated_hotel' END AS fault
        FROM (SELECT CASE s_suppkey % 4 WHEN 1 THEN s_name WHEN 2 THEN 'N' || s_nationkey
                         ELSE 'S' || s_suppkey END AS hotel_id,
                     CASE s_suppkey % 5 WHEN 2 THEN 1 WHEN 3 THEN 0 ELSE 2 END AS rooms,
                     CASE WHEN s_suppkey % 4 = 1 THEN 0 WHEN s_suppkey % 5 = 3 THEN 1
                          WHEN s_suppkey % 5 = 2 THEN 2 WHEN s_suppkey % 5 = 1 THEN 3 END AS fault
              FROM supplier)
        GROUP BY hotel_id""",
    "expected_rooms": f"SELECT hotel_id, room_type_id FROM ({SUPPLIER_ROOMS})",
    "synthetic_grid": f"""
        SELECT hotel_id, room_type_id, CAST(stay_date AS VARCHAR) AS stay_date,
               CAST((list_sum(list_transform(string_split(hotel_id || room_type_id, ''),
                                             lambda x: ascii(x)))
                     + 739886 + datediff('day', DATE '1970-01-01', stay_date) + 719163) % 12
                   AS BIGINT) AS available_rooms,
               CAST(room_no * 30 + day_no AS BIGINT) AS position, CAST(90 AS BIGINT) AS total
        FROM ({SUPPLIER_ROOMS}),
             (SELECT range AS day_no, DATE '2026-09-27' + CAST(range AS INT) AS stay_date
              FROM range(30))""",
    "bad_identifiers": " UNION ALL ".join(
        f"""SELECT '{table}' AS source, '{field}' AS field, count(*) AS refused FROM {table}
            WHERE NOT coalesce(regexp_full_match({field}, {IDENTIFIER}), false)
            HAVING count(*) > 0"""
        for table, field in _TEXT_FIELDS
    ),
    "strict_dates": """
        SELECT o_orderkey, CASE WHEN regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2}')
                    AND NOT starts_with(t, '0000')
                    THEN CAST(TRY_CAST(t AS DATE) AS VARCHAR) END AS parsed
        FROM (SELECT o_orderkey, CASE o_orderkey % 9
                WHEN 1 THEN replace(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '-0', '-')
                WHEN 2 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || 'T00:00:00'
                WHEN 3 THEN ' ' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
                WHEN 4 THEN year(o_orderdate) || '-02-29'
                WHEN 5 THEN '0000-01-01'
                WHEN 6 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || chr(10)
                WHEN 7 THEN '2026-W01-1'
                ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS t
              FROM orders)""",
    "utc_normalised": f"""
        SELECT event_id, {_time("u")} AS observed_at,
               CAST(CAST(u AS DATE) AS VARCHAR) AS snapshot_date
        FROM (SELECT event_id, CASE event_id % 6
                WHEN 0 THEN ts WHEN 1 THEN ts - INTERVAL 2 HOUR
                WHEN 2 THEN ts + INTERVAL 330 MINUTE WHEN 3 THEN ts - INTERVAL 14 HOUR END AS u
              FROM events)""",
    "canonical_text": f"""
        SELECT {_key()}, available_rooms, {_time("observed_at")} AS observed_at FROM ({OBS})""",
    "ndjson_lines": f"""
        SELECT '{{"available_rooms":' || available_rooms || ',"hotel_id":"' || hotel_id
               || '","observed_at":"' || {_time("observed_at")} || '","room_type_id":"' || room_type_id
               || '","snapshot_date":"' || snapshot_date || '","stay_date":"' || stay_date || '"}}' AS line
        FROM ({OBS})""",
    "canonical_rows": f"""
        SELECT hotel_id, room_type_id, CAST(stay_date AS VARCHAR) AS stay_date,
               min(available_rooms) AS available_rooms, '2024-01-31' AS snapshot_date,
               '2024-01-31T06:00:00.000000Z' AS observed_at
        FROM ({OBS}) GROUP BY hotel_id, room_type_id, stay_date""",
    "row_rules": f"SELECT event_id, rule FROM ({RECORDS})",
    "row_rule_report": f"SELECT rule, count(*) AS records FROM ({RECORDS}) GROUP BY rule",
    "typed_counts": """
        SELECT event_id, CASE WHEN event_id % 17 IN (2, 4, 6, 10, 12) THEN NULL
                              WHEN event_id % 17 = 8 THEN -1
                              ELSE CAST(floor(value) AS BIGINT) END AS available_rooms
        FROM events""",
    "unexpected_rooms": f"""
        SELECT room_type_id, count(*) AS records FROM ({OBS}) o
        WHERE NOT EXISTS (SELECT 1 FROM ({ROOMS}) r
                          WHERE r.hotel_id = o.hotel_id AND r.room_type_id = o.room_type_id)
        GROUP BY room_type_id""",
    "stay_date_range": f"""
        SELECT hotel_id, count(*) AS records FROM ({OBS}) WHERE {IN_RANGE} GROUP BY hotel_id""",
    "expected_grid": f"""
        SELECT hotel_id, room_type_id, CAST(stay_date AS VARCHAR) AS stay_date
        FROM ({ROOMS}), {GRID_DAYS}""",
    "missing_cells": f"""
        SELECT hotel_id, room_type_id, CAST(stay_date AS VARCHAR) AS stay_date FROM (
            SELECT hotel_id, room_type_id, stay_date FROM ({ROOMS}), {GRID_DAYS}
            EXCEPT SELECT hotel_id, room_type_id, stay_date FROM ({OBS}))""",
    "coverage_by_room": f"""
        SELECT hotel_id, room_type_id, expected, CAST(records AS BIGINT) AS records, cells,
               conflicts, expected * 20 - cells AS missing,
               CAST(CASE WHEN expected = 1 THEN 0 ELSE records END AS BIGINT) AS unknown_room
        FROM ({_OBS_TALLY})""",
    "coverage_by_hotel": f"""
        SELECT hotel_id, CAST(sum(expected) * 20 AS BIGINT) AS expected_cells,
               CAST(sum(cells) AS BIGINT) AS actual_cells, CAST(sum(records) AS BIGINT) AS records
        FROM ({_OBS_TALLY}) GROUP BY hotel_id""",
    "quality_gate": _GATE_COUNTS + _GATE,
    "collapse_identical": f"""
        SELECT {_key()}, {_time("seen")} AS observed_at, available_rooms, records
        FROM (SELECT {KEY}, observed_at AS seen, min(available_rooms) AS available_rooms,
                     max(available_rooms) AS high, 2 * count(*) AS records
              FROM ({OBS}) GROUP BY {KEY}, observed_at)
        WHERE available_rooms = high""",
    "conflicting_duplicates": f"""
        SELECT hotel_id, room_type_id, CAST(stay_date AS VARCHAR) AS stay_date, low, high, records
        FROM (SELECT hotel_id, room_type_id, stay_date, min(available_rooms) AS low,
                     max(available_rooms) AS high, count(*) AS records
              FROM ({OBS}) GROUP BY 1, 2, 3) WHERE low <> high""",
    "conflicting_duplicates_lines": f"""
        SELECT hotel_id, room_type_id, CAST(stay_date AS VARCHAR) AS stay_date, low, high, records
        FROM (SELECT hotel_id, room_type_id, stay_date, min(available_rooms) AS low,
                     max(available_rooms) AS high, count(*) AS records
              FROM ({LINES}) GROUP BY 1, 2, 3) WHERE low <> high""",
    "hour_conflicts": f"""
        SELECT {_key()}, hour, low, high, records
        FROM (SELECT {KEY}, CAST(hour(observed_at) AS INT) AS hour, min(available_rooms) AS low,
                     max(available_rooms) AS high, count(*) AS records
              FROM ({OBS}) GROUP BY ALL) WHERE low <> high""",
    "batch_duplicate_keys": f"""
        SELECT {_key()}, copies FROM (
            SELECT {KEY}, count(*) AS copies FROM ({OBS}) GROUP BY {KEY}) WHERE copies > 1""",
    "batch_duplicate_keys_lines": f"""
        SELECT {_key()}, copies FROM (
            SELECT {KEY}, count(*) AS copies FROM ({LINES}) GROUP BY {KEY}) WHERE copies > 1""",
    "target_duplicate_keys": f"""
        SELECT {_key()}, copies FROM (
            SELECT {KEY}, count(*) AS copies FROM ({OBS})
            WHERE hour(observed_at) < 12 AND snapshot_date IN (
                SELECT snapshot_date FROM ({OBS}) WHERE hour(observed_at) >= 6)
            GROUP BY {KEY}) WHERE copies > 1""",
    "latest_per_key": f"""
        SELECT {_key()}, available_rooms, {_time("seen")} AS observed_at
        FROM (SELECT * EXCLUDE (observed_at), observed_at AS seen FROM ({_latest(OBS)}))""",
    "merge_newest": _merge(MORNING, DAYTIME),
    "merge_out_of_order": _merge(DAYTIME, MORNING),
    "merge_decisions": _decisions(MORNING, DAYTIME),
    "merge_refusals": _decisions(
        f"SELECT * FROM ({OBS}) WHERE hour(observed_at) < 12",
        f"SELECT * FROM ({OBS}) WHERE hour(observed_at) >= 6",
    ),
    "same_time_conflicts": f"""
        SELECT {_key()} FROM (
            SELECT {KEY} FROM ({_states(_same_day(MORNING), _same_day(DAYTIME))})
            WHERE nt = 1 AND ns = 1 AND tt = st AND tv <> sv)""",
    "conflict_probe": f"""
        SELECT count(*) > 0 AS has_conflict FROM (
            SELECT {KEY} FROM ({_states(_same_day(MORNING), _same_day(DAYTIME))})
            WHERE nt = 1 AND ns = 1 AND tt = st AND tv <> sv)""",
    "published_table": f"""
        SELECT {_key()}, available_rooms, {_time("seen")} AS observed_at
        FROM (SELECT * EXCLUDE (observed_at), observed_at AS seen FROM ({_latest(OBS)}))""",
    "write_outcomes": " UNION ALL ".join(
        [
            _written(1, NOTHING, MORNING),
            _written(2, MORNING, DAYTIME),
            _written(3, _latest(BOTH), DAYTIME),
            _written(4, _latest(BOTH), MORNING),
        ]
    ),
    "acceptance_counts": """
        SELECT step, count(*) * 3 * 365 * days AS rows, count(*) * 3 * 365 * days AS expected_rows
        FROM supplier, (VALUES ('first_snapshot', 1), ('identical_replay', 1), ('second_day', 2))
            s(step, days)
        GROUP BY step, days""",
    "union_snapshots": f"""
        SELECT {_key()}, available_rooms, {_time("seen")} AS observed_at
        FROM (SELECT * EXCLUDE (observed_at), observed_at AS seen FROM ({BOTH}))""",
    "canonical_order": f"""
        SELECT {_key()}, available_rooms, {_time("observed_at")} AS observed_at FROM ({OBS})""",
    "history_range": f"""
        SELECT {_key()}, available_rooms, {_time("observed_at")} AS observed_at FROM ({OBS}) o
        WHERE o.snapshot_date BETWEEN DATE '2024-01-06' AND DATE '2024-01-25'""",
    "history_asof": f"""
        SELECT hotel_id, room_type_id, CAST(stay_date AS VARCHAR) AS stay_date, available_rooms,
               {_time("seen")} AS observed_at, CAST(day AS VARCHAR) AS snapshot_date
        FROM (SELECT hotel_id, room_type_id, stay_date,
                     arg_max(available_rooms, snapshot_date) AS available_rooms,
                     arg_max(observed_at, snapshot_date) AS seen, max(snapshot_date) AS day
              FROM ({_latest(OBS)}) WHERE snapshot_date <= DATE '2024-01-25' GROUP BY 1, 2, 3)""",
    "partition_counts": f"""
        SELECT CAST(day AS VARCHAR) AS snapshot_date, n AS rows
        FROM (SELECT snapshot_date AS day, count(*) AS n FROM ({LINES}) GROUP BY 1)""",
    "affected_partitions": f"""
        SELECT DISTINCT CAST(snapshot_date AS VARCHAR) AS snapshot_date FROM ({LINES})""",
    "reconcile_days": """
        SELECT CAST(DATE '2026-09-27' + CAST(range AS INT) AS VARCHAR) AS snapshot_date,
               count(*) * 3 AS rows, count(*) * 3 AS expected_rows, true AS reconciled
        FROM supplier, range(30) GROUP BY range""",
    "run_summary": f"""
        SELECT CAST(day AS VARCHAR) AS snapshot_date, 'ok' AS status, n AS rows_processed,
               'table' AS sink
        FROM (SELECT snapshot_date AS day, count(*) AS n FROM ({OBS}) GROUP BY 1)""",
    "phase_stats": """
        SELECT event_type, count(value) AS runs, median(value) AS median_value,
               min(value) AS min_value, max(value) AS max_value
        FROM events GROUP BY event_type""",
    "required_nulls": " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) AS rows, count(*) - count({name}) AS nulls FROM ({LINES})"
        for name in (
            "hotel_id", "room_type_id", "stay_date", "available_rooms", "snapshot_date",
            "observed_at",
        )
    ),
    "schema_faults": " UNION ALL ".join(
        [
            f"SELECT '{table}' AS source, (SELECT count(*) FROM {table}) AS rows, "
            f"6 + count(*) AS faults FROM (DESCRIBE {table})"
            for table in TABLES
        ]
        + ["SELECT 'observations', count(*), CAST(0 AS BIGINT) FROM events"]
    ),
    "written_table_faults": f"""
        WITH day AS (SELECT CAST(min(CAST(ts AS DATE)) AS VARCHAR) AS d FROM events)
        SELECT 'extra' AS variant, d || ': unexpected column extra' AS fault FROM day
        UNION ALL SELECT 'narrow', d || ': column available_rooms is int' FROM day
        UNION ALL SELECT 'text', d || ': column observed_at is string' FROM day
        UNION ALL SELECT DISTINCT 'monthly', 'not a daily partition: snapshot_date=' || strftime(ts, '%Y-%m')
        FROM events""",
    "partition_spec": """
        SELECT 'snapshot_date' AS layout, 0 AS position, 'snapshot_date' AS key,
               CAST(CAST(ts AS DATE) AS VARCHAR) AS value, NULL AS fault FROM events
        UNION
        SELECT 'room_type_id/snapshot_date', i, CASE i WHEN 0 THEN 'room_type_id' ELSE 'snapshot_date' END,
               CASE i WHEN 0 THEN event_type ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END,
               'partitioned by [''room_type_id'', ''snapshot_date'']'
        FROM events, (SELECT CAST(range AS INT) AS i FROM range(2))""",
    "stored_asof_day": f"""
        SELECT {_key()}, available_rooms, {_time("seen")} AS observed_at
        FROM (SELECT * EXCLUDE (observed_at), observed_at AS seen FROM ({_latest(OBS)})
              WHERE snapshot_date = (SELECT max(CAST(ts AS DATE)) FROM events
                                     WHERE CAST(ts AS DATE) <= DATE '2024-01-25'))""",
    "stored_history": f"""
        SELECT hotel_id, room_type_id, CAST(stay AS VARCHAR) AS stay_date, days, most
        FROM (SELECT hotel_id, room_type_id, stay_date AS stay, count(*) AS days,
                     max(available_rooms) AS most
              FROM ({_latest(OBS)}) WHERE snapshot_date BETWEEN DATE '2024-01-06' AND DATE '2024-01-25'
              GROUP BY ALL)""",
    "ordered_positions": f"""
        SELECT {_key()}, available_rooms, {_time("observed_at")} AS observed_at, position
        FROM (SELECT *, row_number() OVER (ORDER BY {KEY}, observed_at, available_rooms) - 1 AS position
              FROM ({OBS})) o""",
    "latest_with_ties": f"""
        SELECT {_key()}, available_rooms, {_time("seen")} AS observed_at
        FROM (SELECT {KEY}, max(available_rooms) AS available_rooms,
                     CAST(snapshot_date AS TIMESTAMP) AS seen
              FROM ({OBS}) GROUP BY {KEY})""",
    "exported_lines": f"""
        SELECT '{{"available_rooms":' || available_rooms || ',"hotel_id":"' || hotel_id
               || '","observed_at":"' || {_time("observed_at")} || '","room_type_id":"' || room_type_id
               || '","snapshot_date":"' || snapshot_date || '","stay_date":"' || stay_date || '"}}' AS line
        FROM ({OBS})""",
    "page_files": """
        SELECT 'H' || u AS hotel_id, i + 1 AS page_seq,
               CASE WHEN i > 0 THEN CAST(i * 50 AS VARCHAR) END AS request_cursor,
               CASE WHEN u % 3 = 1 AND i = 1 THEN 'not_json' END AS page_rule,
               CASE WHEN u % 3 = 1 AND i = 1 THEN 0 ELSE least(50, n - i * 50) END AS records
        FROM (SELECT u, n, unnest(range((n + 49) // 50)) AS i
              FROM (SELECT user_id AS u, count(*) AS n FROM events GROUP BY 1))""",
    "inventory_file": f"SELECT hotel_id, room_type_id FROM ({SUPPLIER_ROOMS})",
    "empty_batches": f"""
        WITH held AS (SELECT count(*) AS n, count(DISTINCT snapshot_date) AS d FROM ({_latest(OBS)}))
        SELECT CAST(1 AS BIGINT) AS step, 'empty' AS phase, 'unchanged' AS outcome,
               CAST(0 AS BIGINT) AS days, CAST(0 AS BIGINT) AS rows
        UNION ALL SELECT 2, 'published', 'changed', d, n FROM held
        UNION ALL SELECT 3, 'empty', 'unchanged', 0, n FROM held""",
    # Per check, what a hotel of each kind (suppkey modulo 16) adds to it.
    "quality_gate_defects": "WITH kind AS (SELECT s_suppkey % 16 AS k FROM supplier)\n"
    + "\nUNION ALL ".join(
        f"SELECT '{check}' AS \"check\", CAST(coalesce(sum(CASE "
        + "".join(f"WHEN k = {kind} THEN {n} " for kind, n in by_kind.items())
        + "ELSE 0 END), 0) AS BIGINT) AS failures FROM kind"
        for check, by_kind in _DEFECTS.items()
    )
    + """
UNION ALL SELECT 'row_limit', CAST(greatest(coalesce(sum(CASE WHEN k IN (0, 10, 11, 12) THEN 2
    WHEN k IN (9) THEN 4 WHEN k = 13 THEN 7 WHEN k = 14 THEN 6 WHEN k = 15 THEN 3 ELSE 0 END), 0) - 20, 0)
    AS BIGINT) FROM kind""",
}
