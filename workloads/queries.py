"""One query per operator, over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from staytally.functions import scalars, strict_json
from staytally.operators import coverage, dedup, history, merge, ranking, rules
from staytally.plans import acceptance, collect, reports
from staytally.schema import CELL, COLUMNS, KEY, UNLIMITED, Limits
from staytally.sinks import ndjson, preflight
from staytally.sinks.table import SnapshotTable
from staytally.sources import inventory, pages, synthetic
from staytally.workspace import Workspace
from workloads.views import (
    END,
    HORIZON,
    START,
    as_text,
    daytime,
    event_rooms,
    morning,
    observations,
    order_lines,
    raw_items,
    read,
    supplier_hotels,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STAMP = datetime(2024, 1, 31, 6, tzinfo=UTC)
FIRST_DAY = date(2026, 9, 27)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- pages -----------------------------------------------------------------


def _event_pages(spark: SparkSession, folder: str, page_size: int = 50) -> DataFrame:
    """Raw event records as landed pages of their hotel."""
    numbered = ranking.number_rows(
        raw_items(spark, folder), "hotel_id", ["event_id"], Workspace(spark)
    )
    return pages.paginate(numbered, page_size)


def _line_pages(spark: SparkSession, folder: str) -> DataFrame:
    lines = synthetic.item_text(order_lines(spark, folder))
    order = ["room_type_id", "stay_date", "observed_at", "line_id"]
    rows = lines.select("hotel_id", *order, "item")
    return pages.paginate(ranking.number_rows(rows, "hotel_id", order, Workspace(spark)))


@query
def paginate_table(spark: SparkSession, folder: str) -> DataFrame:
    decoded = pages.decode_pages(_line_pages(spark, folder))
    return pages.page_headers(decoded).select(
        "hotel_id", "page_seq", "request_cursor", "next_cursor", "records"
    )


@query
def pages_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    space = Workspace(spark)
    space.land(_line_pages(spark, folder), "pages")
    scanned = pages.read_pages(spark, f"{space.path}/pages")
    items = pages.explode_pages(pages.decode_pages(scanned))
    cells = items.select(
        "hotel_id",
        strict_json.string_of("item.room_type_id").alias("room_type_id"),
        strict_json.date_of("item.date").alias("stay_date"),
        strict_json.integer_of("item.available").alias("available_rooms"),
    )
    return as_text(cells)


@query
def page_items(spark: SparkSession, folder: str) -> DataFrame:
    """Exploded items keep their place in the page."""
    items = pages.explode_pages(pages.decode_pages(_event_pages(spark, folder)))
    return items.select(
        "hotel_id",
        ((F.col("page_seq") - 1) * 50 + F.col("pos")).cast("bigint").alias("position"),
        strict_json.string_of("item.room_type_id").alias("room_type_id"),
    )


@query
def page_chain_report(spark: SparkSession, folder: str) -> DataFrame:
    """Chain verdicts when some hotels send a wrong, repeated or unended cursor."""
    landed = _line_pages(spark, folder)
    hotel = F.substr("hotel_id", F.lit(2)).cast("bigint")
    second = F.col("page_seq") == 2
    altered = landed.withColumn(
        "request_cursor",
        F.when((hotel % 5 == 1) & second, "elsewhere").otherwise(F.col("request_cursor")),
    ).withColumn(
        "body",
        F.when(
            (hotel % 5 == 2) & second,
            F.regexp_replace("body", '"next_cursor": .*', '"next_cursor": "128"}'),
        )
        .when(
            hotel % 5 == 3,
            F.replace("body", F.lit('"next_cursor": null'), F.lit('"next_cursor": "more"')),
        )
        .otherwise(F.col("body")),
    )
    headers = pages.page_headers(pages.decode_pages(altered))
    verdicts = pages.page_chain(headers, supplier_hotels(spark, folder), UNLIMITED)
    return verdicts.select(
        "hotel_id", "pages", "records", "starts", "repeated_pages", "repeated_cursors",
        "broken_links", "chain_rule",
    )


@query
def volume_limits(spark: SparkSession, folder: str) -> DataFrame:
    headers = pages.page_headers(pages.decode_pages(_event_pages(spark, folder, 10)))
    limits = Limits(max_rows=None, max_pages=9, max_items=70)
    verdicts = pages.page_chain(headers, headers, limits)
    return verdicts.select("hotel_id", "pages", "records", "chain_rule")


@query
def page_shape_report(spark: SparkSession, folder: str) -> DataFrame:
    """Page rules over well-formed and malformed bodies built around each record."""
    bodies = raw_items(spark, folder).selectExpr(
        "hotel_id",
        "bigint(event_id) AS page_seq",
        "string(NULL) AS request_cursor",
        """CASE event_id % 12
            WHEN 1 THEN concat('[', item, ']')
            WHEN 2 THEN 'null'
            WHEN 3 THEN concat('{"items": [', item, ']}')
            WHEN 4 THEN concat('{"items": ', item, ', "next_cursor": null}')
            WHEN 5 THEN concat('{"items": [', item, ', 1], "next_cursor": null}')
            WHEN 6 THEN concat('{"items": [', item, '], "next_cursor": false}')
            WHEN 7 THEN concat('{"items": [', item, '], "next_cursor": ""}')
            WHEN 8 THEN concat('{"items": [', item, '], "next_cursor": null} trailing')
            WHEN 9 THEN concat('{"items": [', item, '], "items": [], "next_cursor": null}')
            WHEN 10 THEN concat('{"items": [', item, '], "next_cursor": NaN}')
            WHEN 11 THEN concat('{"items": [', item, '], "next_cursor": "', repeat('x', 4097), '"}')
            ELSE concat('{"items": [', item, '], "next_cursor": null}') END AS body""",
    )
    decoded = pages.decode_pages(bodies, Limits(max_cursor_chars=4_096))
    return decoded.groupBy("page_rule").agg(
        F.count("*").alias("pages"), F.sum(F.size("items")).alias("accepted_items")
    )


@query
def props_strict(spark: SparkSession, folder: str) -> DataFrame:
    parsed = strict_json.with_strict_json(read(spark, folder, "events"), "props", "doc")
    return parsed.select(
        "event_id",
        strict_json.integer_of(F.try_variant_get("doc", "$.k", "variant")).alias("k"),
    )


@query
def strict_json_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """Which spellings of one document are refused."""
    texts = read(spark, folder, "events").selectExpr(
        "event_id",
        """CASE event_id % 8
            WHEN 1 THEN concat(props, ' x')
            WHEN 2 THEN concat(props, props)
            WHEN 3 THEN replace(props, '}', ', "k": 1}')
            WHEN 4 THEN '{"k": NaN}'
            WHEN 5 THEN replace(props, '}', '')
            WHEN 6 THEN concat(props, ']')
            WHEN 7 THEN concat(' ', props, ' ')
            ELSE props END AS text""",
    )
    parsed = strict_json.with_strict_json(texts, "text", "doc")
    return parsed.select("event_id", F.col("doc").isNotNull().alias("accepted"))


@query
def document_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Whole document texts carried as JSON strings come back unchanged."""
    texts = read(spark, folder, "documents").select(
        "doc_id", "text", F.to_json(F.struct("text")).alias("body")
    )
    parsed = strict_json.with_strict_json(texts, "body", "doc")
    back = strict_json.string_of(F.try_variant_get("doc", "$.text", "variant"))
    return parsed.select(
        "doc_id", F.length(back).cast("bigint").alias("chars"), (back == F.col("text")).alias("same")
    )


# --- inventory and synthetic data --------------------------------------------


@query
def inventory_faults(spark: SparkSession, folder: str) -> DataFrame:
    hotels = read(spark, folder, "supplier").selectExpr(
        """CASE s_suppkey % 4 WHEN 1 THEN s_name WHEN 2 THEN concat('N', s_nationkey)
            ELSE concat('S', s_suppkey) END AS hotel_id""",
        """CASE s_suppkey % 5 WHEN 1 THEN array('single', 'single')
            WHEN 2 THEN array('bad room') WHEN 3 THEN array()
            ELSE array('single', 'double') END AS room_type_ids""",
    )
    return inventory.hotel_faults(hotels)


@query
def expected_rooms(spark: SparkSession, folder: str) -> DataFrame:
    return inventory.expected_rooms(supplier_hotels(spark, folder))


@query
def synthetic_grid(spark: SparkSession, folder: str) -> DataFrame:
    items = synthetic.synthetic_items(
        supplier_hotels(spark, folder), FIRST_DAY, date(2026, 10, 26), FIRST_DAY
    )
    return as_text(items)


# --- scalar rules --------------------------------------------------------------


@query
def bad_identifiers(spark: SparkSession, folder: str) -> DataFrame:
    texts = [
        ("orders", "o_orderpriority"),
        ("supplier", "s_name"),
        ("customer", "c_name"),
        ("customer", "c_mktsegment"),
        ("part", "p_name"),
        ("part", "p_brand"),
        ("documents", "text"),
        ("pages", "url"),
    ]
    checked = [
        read(spark, folder, table)
        .where(~scalars.is_identifier(column))
        .groupBy(F.lit(table).alias("source"), F.lit(column).alias("field"))
        .agg(F.count("*").alias("refused"))
        for table, column in texts
    ]
    return history.union_snapshots(*checked)


@query
def strict_dates(spark: SparkSession, folder: str) -> DataFrame:
    texts = read(spark, folder, "orders").selectExpr(
        "o_orderkey",
        """CASE o_orderkey % 9
            WHEN 1 THEN replace(string(date(o_orderdate)), '-0', '-')
            WHEN 2 THEN concat(string(date(o_orderdate)), 'T00:00:00')
            WHEN 3 THEN concat(' ', string(date(o_orderdate)))
            WHEN 4 THEN concat(year(o_orderdate), '-02-29')
            WHEN 5 THEN '0000-01-01'
            WHEN 6 THEN concat(string(date(o_orderdate)), '\n')
            WHEN 7 THEN '2026-W01-1'
            ELSE string(date(o_orderdate)) END AS text""",
    )
    return as_text(texts.select("o_orderkey", scalars.strict_date("text").alias("parsed")))


@query
def utc_normalised(spark: SparkSession, folder: str) -> DataFrame:
    texts = read(spark, folder, "events").selectExpr(
        "event_id",
        """concat(replace(string(ts), ' ', 'T'), CASE event_id % 6
            WHEN 1 THEN '+02:00' WHEN 2 THEN '-05:30' WHEN 3 THEN '+14:00'
            WHEN 4 THEN '' WHEN 5 THEN '+2' ELSE 'Z' END) AS text""",
    )
    wall = scalars.utc_wall_of_text("text")
    return as_text(
        texts.select(
            "event_id", wall.alias("observed_at"), wall.cast("date").alias("snapshot_date")
        )
    )


@query
def canonical_text(spark: SparkSession, folder: str) -> DataFrame:
    return ndjson.canonical_text(observations(spark, folder))


@query
def ndjson_lines(spark: SparkSession, folder: str) -> DataFrame:
    return ndjson.ndjson_lines(observations(spark, folder))


@query
def canonical_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Accepted cells as six typed fields under the run's shared stamp."""
    run = collect.run_options(START, HORIZON, STAMP)
    cells = dedup.collapse(observations(spark, folder), CELL)
    return ndjson.canonical_text(collect.accepted_rows(cells, run))


# --- record rules and joins ------------------------------------------------------


def _read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Each event as a one-record page, through decode and the local rules."""
    bodies = raw_items(spark, folder).selectExpr(
        "hotel_id",
        "bigint(event_id) AS page_seq",
        "string(NULL) AS request_cursor",
        """concat('{"items": [', item, '], "next_cursor": null}') AS body""",
    )
    items = pages.explode_pages(pages.decode_pages(bodies))
    return rules.read_items(items, START, END)


@query
def row_rules(spark: SparkSession, folder: str) -> DataFrame:
    classified = rules.classify(_read_records(spark, folder), event_rooms(spark, folder))
    return classified.select(F.col("page_seq").cast("bigint").alias("event_id"), "rule")


@query
def row_rule_report(spark: SparkSession, folder: str) -> DataFrame:
    return rules.rule_counts(
        rules.classify(_read_records(spark, folder), event_rooms(spark, folder))
    )


@query
def typed_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _read_records(spark, folder).select(
        F.col("page_seq").cast("bigint").alias("event_id"), "available_rooms"
    )


@query
def unexpected_rooms(spark: SparkSession, folder: str) -> DataFrame:
    """Observations whose (hotel, room) nobody expects, by room."""
    strangers = rules.unexpected_items(observations(spark, folder), event_rooms(spark, folder))
    return strangers.groupBy("room_type_id").agg(F.count("*").alias("records"))


@query
def stay_date_range(spark: SparkSession, folder: str) -> DataFrame:
    inside = observations(spark, folder).where(rules.in_range(F.col("stay_date"), START, END))
    return inside.groupBy("hotel_id").agg(F.count("*").alias("records"))


# --- completeness ------------------------------------------------------------------


@query
def expected_grid(spark: SparkSession, folder: str) -> DataFrame:
    return as_text(coverage.expected_grid(event_rooms(spark, folder), START, END))


@query
def missing_cells(spark: SparkSession, folder: str) -> DataFrame:
    missing = coverage.missing_cells(
        event_rooms(spark, folder), observations(spark, folder), START, END
    )
    return as_text(missing)


def _observed_tally(spark: SparkSession, folder: str) -> DataFrame:
    rows = observations(spark, folder).where(rules.in_range(F.col("stay_date"), START, END))
    cells = dedup.collapse(rows).withColumn("rule", F.lit(None).cast("string"))
    return coverage.room_tally(event_rooms(spark, folder), cells, HORIZON)


@query
def coverage_by_room(spark: SparkSession, folder: str) -> DataFrame:
    return _observed_tally(spark, folder).select(
        "hotel_id", "room_type_id", "expected", "records", "cells", "conflicts", "missing",
        "unknown_room",
    )


@query
def coverage_by_hotel(spark: SparkSession, folder: str) -> DataFrame:
    return coverage.hotel_coverage(_observed_tally(spark, folder), HORIZON)


@query
def quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Every check of a whole batch of defective pages, with its failures."""
    listed = event_rooms(spark, folder).groupBy("hotel_id")
    hotels = listed.agg(F.collect_list("room_type_id").alias("room_type_ids"))
    limits = Limits(max_rows=5_000, max_items=70, max_pages=1)
    run = collect.run_options(START, HORIZON, STAMP)
    landed = collect.land_batch(_event_pages(spark, folder), hotels, run, limits, Workspace(spark))
    return spark.createDataFrame(
        list(collect.gate(landed, limits).items()), "check string, failures bigint"
    )


# --- repeated keys ---------------------------------------------------------------------


@query
def collapse_identical(spark: SparkSession, folder: str) -> DataFrame:
    rows = observations(spark, folder)
    doubled = history.union_snapshots(rows, rows)
    return as_text(dedup.identical_collapsed(doubled, [*KEY, "observed_at"]))


@query
def conflicting_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return as_text(dedup.conflicting(observations(spark, folder)))


@query
def conflicting_duplicates_lines(spark: SparkSession, folder: str) -> DataFrame:
    return as_text(dedup.conflicting(order_lines(spark, folder)))


@query
def hour_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    """Copies of one key within one hour that disagree."""
    hourly = observations(spark, folder).withColumn("hour", F.hour("observed_at"))
    return as_text(dedup.conflicting(hourly, [*KEY, "hour"]))


@query
def batch_duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return as_text(dedup.duplicate_keys(observations(spark, folder)))


@query
def batch_duplicate_keys_lines(spark: SparkSession, folder: str) -> DataFrame:
    return as_text(dedup.duplicate_keys(order_lines(spark, folder)))


@query
def target_duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    rows = observations(spark, folder)
    days = merge.affected_days(daytime(rows))
    return as_text(dedup.duplicate_keys(morning(rows).where(scalars.on_days("snapshot_date", days))))


@query
def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    return as_text(dedup.latest(observations(spark, folder)))


# --- merge --------------------------------------------------------------------------------


def _two_batches(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = observations(spark, folder)
    return dedup.latest(morning(rows)), dedup.latest(daytime(rows))


@query
def merge_newest(spark: SparkSession, folder: str) -> DataFrame:
    first, second = _two_batches(spark, folder)
    return as_text(merge.merge_states(first, second))


@query
def merge_out_of_order(spark: SparkSession, folder: str) -> DataFrame:
    first, second = _two_batches(spark, folder)
    return as_text(merge.merge_states(second, first))


@query
def merge_decisions(spark: SparkSession, folder: str) -> DataFrame:
    first, second = _two_batches(spark, folder)
    return merge.decision_counts(merge.merge_states(first, second))


@query
def merge_refusals(spark: SparkSession, folder: str) -> DataFrame:
    """Decisions when neither side has unique keys."""
    rows = observations(spark, folder)
    return merge.decision_counts(merge.merge_states(morning(rows), daytime(rows)))


def _same_day_stamps(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Two batches that claim one observation time per day."""
    def stamped(rows: DataFrame) -> DataFrame:
        return rows.withColumn("observed_at", F.col("snapshot_date").cast("timestamp_ntz"))

    first, second = _two_batches(spark, folder)
    return stamped(first), stamped(second)


@query
def same_time_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    return as_text(merge.same_time_conflicts(*_same_day_stamps(spark, folder)))


@query
def conflict_probe(spark: SparkSession, folder: str) -> DataFrame:
    return merge.has_conflict(*_same_day_stamps(spark, folder))


# --- table, history and reports --------------------------------------------------------------


def _instants(rows: DataFrame) -> DataFrame:
    """Observation times as instants, which is what the table stores."""
    return rows.select(COLUMNS).withColumn("observed_at", scalars.instant_of_wall("observed_at"))


def _published(spark: SparkSession, folder: str) -> tuple[SnapshotTable, list]:
    first, second = (_instants(batch) for batch in _two_batches(spark, folder))
    table = SnapshotTable(spark, f"{Workspace(spark).path}/table")
    return table, [table.write(batch) for batch in (first, second, second, first)]


@query
def published_table(spark: SparkSession, folder: str) -> DataFrame:
    table, _ = _published(spark, folder)
    return ndjson.canonical_text(table.read())


@query
def write_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    _, results = _published(spark, folder)
    rows = [
        (step, r.outcome, r.insert, r.update, r.replay, r.stale, r.keep)
        for step, r in enumerate(results, 1)
    ]
    return spark.createDataFrame(
        rows,
        "step bigint, outcome string, inserted bigint, updated bigint, replayed bigint, "
        "stale bigint, kept bigint",
    )


@query
def acceptance_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The full import twice plus a replay, from generated pages to the reconciled table."""
    return acceptance.acceptance_run(
        supplier_hotels(spark, folder), Workspace(spark).path, first_day=FIRST_DAY, export=False
    )


@query
def union_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    first, second = _two_batches(spark, folder)
    return as_text(history.union_snapshots(first, second))


@query
def canonical_order(spark: SparkSession, folder: str) -> DataFrame:
    return as_text(history.canonical_order(observations(spark, folder)))


@query
def history_range(spark: SparkSession, folder: str) -> DataFrame:
    return as_text(history.history(observations(spark, folder), START, END))


@query
def history_asof(spark: SparkSession, folder: str) -> DataFrame:
    table = dedup.latest(observations(spark, folder))
    return as_text(history.as_of(table, END))


@query
def partition_counts(spark: SparkSession, folder: str) -> DataFrame:
    return as_text(history.rows_per_day(order_lines(spark, folder)))


@query
def affected_partitions(spark: SparkSession, folder: str) -> DataFrame:
    days = order_lines(spark, folder).select("snapshot_date").distinct()
    return days.select(F.col("snapshot_date").cast("string"))


@query
def reconcile_days(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per day of the synthetic grid against rooms expected per day."""
    items = synthetic.synthetic_items(
        supplier_hotels(spark, folder), FIRST_DAY, date(2026, 10, 26), FIRST_DAY
    )
    expected = supplier_hotels(spark, folder).count() * 3
    daily = items.withColumnRenamed("stay_date", "snapshot_date")
    return as_text(reports.reconcile(daily, expected))


@query
def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return as_text(reports.run_summary(observations(spark, folder), "table"))


@query
def phase_stats(spark: SparkSession, folder: str) -> DataFrame:
    events = read(spark, folder, "events")
    return reports.run_statistics(events, "event_type", "value", Workspace(spark))


@query
def required_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return preflight.null_counts(order_lines(spark, folder))


TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


@query
def schema_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Every driver table against the canonical schema; only the right one has no faults."""
    tables = {name: read(spark, folder, name) for name in TABLES}
    tables["observations"] = _instants(observations(spark, folder))
    found = [
        frame.groupBy(F.lit(name).alias("source"))
        .agg(F.count("*").alias("rows"))
        .withColumn("faults", F.lit(len(preflight.schema_faults(frame.schema))).cast("bigint"))
        for name, frame in tables.items()
    ]
    return history.union_snapshots(*found)


# --- what is stored: faults, partitions, days, files --------------------------------------------


@query
def written_table_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Tables with one wrong day each, among right ones; the check names that day."""
    rows = _instants(dedup.latest(observations(spark, folder)))
    space = Workspace(spark)
    first = rows.agg(F.min("snapshot_date")).first()[0]
    wrong = F.col("snapshot_date") == scalars.day_literal(first)
    variants = {
        "right": None,
        "extra": rows.withColumn("extra", F.lit(1)),
        "narrow": rows.withColumn("available_rooms", F.col("available_rooms").cast("int")),
        "text": rows.withColumn("observed_at", F.lit("noon")),
        "monthly": rows.withColumn("snapshot_date", F.date_format("snapshot_date", "yyyy-MM")),
    }
    found = []
    for name, variant in variants.items():
        path = f"{space.path}/{name}"
        if name == "monthly":
            variant.write.partitionBy("snapshot_date").parquet(path)
        else:
            rows.write.partitionBy("snapshot_date").parquet(path)
        if name not in ("right", "monthly"):
            writer = variant.where(wrong).write.option("partitionOverwriteMode", "dynamic")
            writer.mode("overwrite").partitionBy("snapshot_date").parquet(path)
        table = SnapshotTable(spark, path)
        found += [(name, fault) for fault in table.faults(table.days() if name != "monthly" else [])]
    return spark.createDataFrame(found, "variant string, fault string")


@query
def partition_spec(spark: SparkSession, folder: str) -> DataFrame:
    """Catalog partitions of a right and a wrong table, and what the check says of each."""
    rows = _instants(dedup.latest(observations(spark, folder)))
    made, found = [], []
    try:
        for layout in (["snapshot_date"], ["room_type_id", "snapshot_date"]):
            name = f"spec_{Workspace(spark).run_id}"
            made.append(name)
            rows.write.partitionBy(*layout).format("parquet").saveAsTable(name)
            faults = ", ".join(preflight.catalog_faults(spark, name)) or None
            spec = preflight.catalog_partitions(spark, name)
            found.append(
                spec.select(
                    F.lit("/".join(layout)).alias("layout"), "position", "key", "value",
                    F.lit(faults).cast("string").alias("fault"),
                ).distinct()
            )
        both = found[0].unionByName(found[1])
        return Workspace(spark).land(both, "spec")
    finally:
        for name in made:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _stored(spark: SparkSession, folder: str) -> SnapshotTable:
    table = SnapshotTable(spark, f"{Workspace(spark).path}/table")
    table.write(_instants(dedup.latest(observations(spark, folder))))
    return table


@query
def stored_asof_day(spark: SparkSession, folder: str) -> DataFrame:
    """The newest stored day not after the date asked for, from a written table."""
    return ndjson.canonical_text(_stored(spark, folder).as_of(END))


@query
def stored_history(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per stay date seen over a range of stored days."""
    days = history.history(_stored(spark, folder).read(), START, END)
    seen = days.groupBy("hotel_id", "room_type_id", "stay_date").agg(
        F.count("*").alias("days"), F.max("available_rooms").alias("most")
    )
    return as_text(seen)


@query
def ordered_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Every observation with its place in the canonical order."""
    return as_text(history.ordered_positions(observations(spark, folder), Workspace(spark)))


@query
def latest_with_ties(spark: SparkSession, folder: str) -> DataFrame:
    """Observation times cut to the day, so that most keys have copies of one time."""
    rows = observations(spark, folder)
    return as_text(dedup.latest(rows.withColumn("observed_at", F.date_trunc("DAY", "observed_at").cast("timestamp_ntz"))))


@query
def exported_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The export of a first batch, replaced by that of all observations, read back."""
    rows, path = observations(spark, folder), f"{Workspace(spark).path}/export"
    ndjson.export_ndjson(morning(rows), path)
    ndjson.export_ndjson(rows, path, replace=True)
    return ndjson.read_ndjson(spark, path).withColumnRenamed("value", "line")


@query
def page_files(spark: SparkSession, folder: str) -> DataFrame:
    """Bodies landed as raw files and read back; some second pages are not UTF-8."""
    hotel = F.substr("hotel_id", F.lit(2)).cast("bigint")
    broken = (hotel % 3 == 1) & (F.col("page_seq") == 2)
    body = F.when(broken, F.concat("body", F.expr("CAST(unhex('FF') AS STRING)"))).otherwise(F.col("body"))
    root = f"{Workspace(spark).path}/files"
    pages.write_page_files(_event_pages(spark, folder).withColumn("body", body), root)
    decoded = pages.decode_pages(pages.read_page_files(spark, root))
    return decoded.select(
        "hotel_id", "page_seq", "request_cursor", "page_rule",
        F.size("items").cast("bigint").alias("records"),
    )


@query
def inventory_file(spark: SparkSession, folder: str) -> DataFrame:
    """The supplier inventory as one configuration document, written and read back."""
    path = f"{Workspace(spark).path}/hotels"
    inventory.write_hotels(supplier_hotels(spark, folder), path)
    return inventory.expected_rooms(inventory.read_hotels(spark, path, parts=True))


@query
def empty_batches(spark: SparkSession, folder: str) -> DataFrame:
    """A batch without rows before and after a real one: nothing happens either time."""
    rows = _instants(dedup.latest(observations(spark, folder)))
    nothing = rows.where("available_rooms < 0 AND available_rooms > 0")
    table, steps = SnapshotTable(spark, f"{Workspace(spark).path}/table"), []
    for step, part in enumerate((nothing, rows, nothing), 1):
        result = table.write(part)
        held = table.read().count() if table.exists() else 0
        steps.append((step, result.phase, result.outcome, result.days_published, held))
    return spark.createDataFrame(
        steps, "step bigint, phase string, outcome string, days bigint, rows bigint"
    )


_ROOMS_OF = ["single"]


@query
def quality_gate_defects(spark: SparkSession, folder: str) -> DataFrame:
    """Sixteen kinds of hotels, dealt over the suppliers; with all kinds every check fires."""
    limits = Limits(max_rows=20, max_items=6, max_pages=3, max_response_bytes=5_000)
    day, following = "2024-01-06", "2024-01-07"

    def item(date: str = day, count: str = "4", room: str = "single", more: str = "") -> str:
        return f'{{"room_type_id": "{room}", "date": "{date}", "available": {count}{more}}}'

    def body(*items: str, cursor: str = "null") -> str:
        return f'{{"items": [{", ".join(items)}], "next_cursor": {cursor}}}'

    both = (item(), item(following, "0"))
    kinds = {
        0: [(1, None, body(*both))],
        1: [(1, None, body(*both) + " " * 5_000)],
        2: [(1, None, body(*both) + "]")],
        3: [(1, None, "[]")],
        4: [(1, None, '{"items": []}')],
        5: [(1, None, body("7"))],
        6: [(1, None, body(*both, cursor="false"))],
        7: [(1, None, body())],
        8: [],
        9: [(1, None, body(*both)), (1, None, body(both[1], both[0]))],
        10: [(1, None, body(both[0], cursor='"a"')), (2, "a", body(cursor='"a"')), (3, "a", body(both[1]))],
        11: [(1, None, body(*both, cursor='"b"'))],
        12: [(n, f"c{n}" if n > 1 else None, body(*both[n - 1 : n], cursor=f'"c{n + 1}"' if n < 4 else "null")) for n in range(1, 5)],
        13: [(1, None, body(*both, *[both[0]] * 5))],
        14: [(1, None, body(
            item(more=', "hotel_id": "other"'), item(room="attic"), item("2024-01-6"),
            item("2024-01-08"), item(count="4.0"), item(count="-1"),
        ))],
        15: [(1, None, body(*both, item(count="5")))],
    }
    rows = [(kind, *page) for kind, listed in kinds.items() for page in listed]
    kind = (F.col("s_suppkey") % 16).cast("bigint")
    suppliers = read(spark, folder, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("hotel_id"), kind.alias("kind")
    )
    forms = spark.createDataFrame(rows, "kind bigint, page_seq bigint, request_cursor string, body string")
    landed = suppliers.join(F.broadcast(forms), "kind").drop("kind")
    hotels = suppliers.where("kind <> 7").select(
        "hotel_id", F.array(*map(F.lit, _ROOMS_OF)).alias("room_type_ids")
    )
    run = collect.run_options(START, 2, STAMP)
    batch = collect.land_batch(landed, hotels, run, limits, Workspace(spark))
    return spark.createDataFrame(
        list(collect.gate(batch, limits).items()), "check string, failures bigint"
    )
