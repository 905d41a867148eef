"""The plans that make the operators hold at scale."""

import re
from datetime import UTC, date, datetime, timedelta
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from samples import STAMP, START, batch, hotels, items, pages, row
from staytally import SnapshotTable, fs
from staytally.operators import coverage, dedup, history, merge, ranking, rules
from staytally.plans.collect import gate, land_batch, require_inventory, run_options
from staytally.schema import KEY, Limits
from staytally.sources import pages as P
from staytally.sources.inventory import expected_rooms
from staytally.workspace import Workspace


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def exchanges(frame):
    return len(re.findall(r"Exchange (?:hash|range|SinglePartition)", plan(frame)))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    table = SnapshotTable(spark, str(tmp_path_factory.mktemp("plans") / "table"))
    six = datetime(2026, 9, 27, 6, tzinfo=UTC)
    table.write(batch(spark, *(row(at=six + timedelta(days=d)) for d in range(4))))
    return table


def test_merge_is_one_combining_shuffle(spark, stored):
    merged = merge.merge_states(stored.read(), stored.read())
    assert exchanges(merged) == 1
    text = plan(merged)
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text and "Join" not in text


def test_key_aggregates_are_one_combining_shuffle(spark, stored):
    for frame in (
        dedup.latest(stored.read()),
        dedup.duplicate_keys(stored.read()),
        dedup.collapse(stored.read(), KEY),
        history.as_of(stored.read(), date(2026, 9, 28)),
    ):
        assert exchanges(frame) == 1
        assert "partial_" in plan(frame) and "SortAggregate" not in plan(frame)


def test_history_prunes_partitions(spark, stored):
    text = plan(history.history(stored.read(), date(2026, 9, 28), date(2026, 9, 29)))
    assert re.search(r"PartitionFilters: \[.*snapshot_date.*2026-09-28", text)
    text = plan(history.as_of(stored.read(), date(2026, 9, 28)))
    assert re.search(r"PartitionFilters: \[.*snapshot_date", text)


def test_only_the_touched_days_are_listed(spark, stored):
    days = stored.read_days([date(2026, 9, 28), date(2030, 1, 1)])
    assert len(days.inputFiles()) == 1
    assert stored.read_days([date(2030, 1, 1)]) is None


def test_bodies_are_parsed_once_without_a_shuffle(spark):
    landed = pages(spark, items())
    end = START + timedelta(days=2)
    read = rules.read_items(P.explode_pages(P.decode_pages(landed)), START, end)
    assert plan(read).count("parseJson") == 1
    assert exchanges(read) == 0
    assert "Python" not in plan(read)


def test_an_import_is_one_pass_of_two_combining_shuffles(spark):
    """Records meet by cell, cells and inventory by room; the checks are counted on the way out."""
    landed = []

    class Captured(Exception):
        pass

    class Space:
        def land_counted(self, frame, _, counts):
            landed.append((frame, counts))
            raise Captured

    run = run_options(START, 3, STAMP)
    with pytest.raises(Captured):
        land_batch(pages(spark, items()), hotels(spark), run, Limits(), Space())
    frame, counts = landed[0]
    text = plan(frame)
    assert text.count("parseJson") == 1
    assert exchanges(frame) == 2
    assert "SortAggregate" not in text and "Python" not in text and "Join" not in text
    assert set(counts) > {*rules.RULES, *P.PAGE_RULES, "conflict", "incomplete"}


def test_pages_and_inventory_are_read_once(spark, tmp_path):
    """Both sources change after the batch has been landed, and the checks do not notice."""
    pages(spark, items()).write.parquet(str(tmp_path / "pages"))
    hotels(spark).write.parquet(str(tmp_path / "hotels"))
    sources = [spark.read.parquet(str(tmp_path / name)) for name in ("pages", "hotels")]
    space = Workspace(spark)
    landed = land_batch(*sources, run_options(START, 3, STAMP), Limits(), space)
    for name in ("pages", "hotels"):
        fs.delete(spark, str(tmp_path / name))
    assert require_inventory(landed) == 3
    assert set(gate(landed, Limits()).values()) == {0}
    assert landed.cells.count() == 9
    space.close()


def test_chain_check_has_no_window_and_no_join(spark):
    headers = P.page_headers(P.decode_pages(pages(spark, items())))
    text = plan(P.page_chain(headers, hotels(spark), Limits()))
    assert "Window" not in text and "Join" not in text


def test_grid_is_generated_without_a_join(spark):
    """The rooms, not the cells, are shuffled, and AQE cannot merge their partitions."""
    grid = coverage.expected_grid(expected_rooms(hotels(spark)), START, START)
    assert "Join" not in plan(grid) and exchanges(grid) == 1
    assert "REPARTITION_BY_NUM" in plan(grid)
    assert plan(grid).index("Generate") < plan(grid).index("REPARTITION_BY_NUM")


def test_one_large_hotel_is_generated_by_many_tasks(spark):
    rooms = "transform(sequence(1, 400), i -> concat('r', i)) AS room_type_ids"
    large = spark.range(1).selectExpr("'h' AS hotel_id", rooms)
    grid = coverage.expected_grid(expected_rooms(large), START, START + timedelta(days=9))
    sizes = [n for n in grid.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    assert sum(sizes) == 4000 and max(sizes) < 2000


def test_membership_tally_has_no_join(spark):
    cells = spark.createDataFrame(
        [], "hotel_id string, room_type_id string, rule string, low long, high long, records long"
    )
    tally = coverage.room_tally(expected_rooms(hotels(spark)), cells, 3)
    assert "Join" not in plan(tally) and exchanges(tally) == 1


def _jobs(spark, action):
    """Number of Spark jobs of an action, and how many tasks their result stages ran."""
    group = f"jobs-{uuid4()}"
    spark.sparkContext.setJobGroup(group, "counted")
    result = action()
    spark.sparkContext.setJobGroup("other", "not counted")
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup(group)]
    last = [tracker.getStageInfo(max(job.stageIds)) for job in jobs if job and len(job.stageIds)]
    return result, len(jobs), [stage.numTasks for stage in last if stage]


def test_jobs_of_a_write_do_not_grow_with_its_days(spark, tmp_path):
    def update(days):
        table = SnapshotTable(spark, str(tmp_path / f"table-{days}"))
        at = [STAMP + timedelta(days=d) for d in range(days)]
        table.write(batch(spark, *(row(at=t) for t in at)))
        newer = batch(spark, *(row(rooms=1, at=t + timedelta(hours=1)) for t in at))
        result, jobs, _ = _jobs(spark, lambda: table.write(newer))
        assert (result.update, result.days_published) == (days, days)
        return jobs

    # Beyond 32 folders Spark lists them by a job as well.
    assert update(80) == update(40) <= update(4) + 2 <= 10


def test_a_probe_stops_at_the_first_conflict(spark):
    keys = spark.range(4_000).selectExpr(
        "concat('h', id) AS hotel_id", "'r' AS room_type_id", "DATE '2028-01-01' AS stay_date",
        "id AS available_rooms", "DATE '2026-09-27' AS snapshot_date",
        "TIMESTAMP '2026-09-27 06:00:00' AS observed_at",
    )
    other = keys.withColumn("available_rooms", F.col("available_rooms") + 1)
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        found, _, tasks = _jobs(spark, lambda: merge.any_conflict(keys, other))
        assert found and sum(tasks) < 8
        found, _, tasks = _jobs(spark, lambda: merge.any_conflict(keys, keys))
        assert not found and sum(tasks) >= 64
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_as_of_reads_the_one_day_it_needs(spark, tmp_path):
    """Every other day's files are broken, so opening one of them would fail."""
    table = SnapshotTable(spark, str(tmp_path / "table"))
    table.write(batch(spark, *(row(at=STAMP + timedelta(days=d)) for d in range(4))))
    for file in (tmp_path / "table").glob("snapshot_date=*/*.parquet"):
        if "2026-09-29" not in str(file):
            file.write_bytes(b"broken")
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    found = table.as_of(date(2026, 9, 29))
    assert re.search(r"PartitionFilters: \[.*snapshot_date.*subquery", plan(found), re.IGNORECASE)
    assert [r.snapshot_date for r in found.collect()] == [date(2026, 9, 29)]
    assert table.as_of(date(2020, 1, 1)).isEmpty()
    with pytest.raises(Exception, match="parquet|Parquet|PARQUET"):
        table.as_of(date(2040, 1, 1)).collect()


def test_numbering_lands_its_rows_once(spark):
    labels = []

    class Counting(Workspace):
        def land(self, frame, label):
            labels.append(label)
            return super().land(frame, label)

    rows = spark.range(1000).selectExpr("id % 7 AS g", "1000 - id AS v")
    numbered = ranking.number_rows(rows, "g", ["v"], Counting(spark)).collect()
    assert len(labels) == 1
    for g in range(7):
        group = sorted((r.v, r.position, r.total) for r in numbered if r.g == g)
        assert [p for _, p, _ in group] == list(range(len(group)))
        assert {t for *_, t in group} == {len(group)}
    placed = ranking.global_positions(rows, ["v"], Counting(spark)).collect()
    assert len(labels) == 2
    assert [r.v for r in sorted(placed, key=lambda r: r.position)] == list(range(1, 1001))
    assert sorted(r.position for r in placed) == list(range(1000))


@pytest.mark.parametrize("reverse", [False, True])
def test_ties_fold_to_the_larger_count_in_any_order(spark, reverse):
    old = datetime(1400, 1, 1, tzinfo=UTC)
    rows = [row(rooms=n, at=STAMP) for n in (3, 9, 4)] + [row(rooms=99, at=STAMP - timedelta(days=0, hours=1))]
    rows += [row(hotel="b", rooms=n, at=old) for n in (2**63 - 1, -(2**63))]
    rows = [r[:4] + (date(2026, 9, 27), r[5]) for r in rows]
    frame = batch(spark, *(reversed(rows) if reverse else rows)).repartition(3)
    found = {r.hotel_id: (r.available_rooms, r.observed_at.astimezone(UTC)) for r in dedup.latest(frame).collect()}
    assert found == {"demo": (9, STAMP), "b": (2**63 - 1, old)}
