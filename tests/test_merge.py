from datetime import UTC, datetime, timedelta

from hypothesis import HealthCheck, given, settings, strategies as st

from samples import batch, listed, row
from staytally.operators import dedup, merge
from staytally.schema import COLUMNS, KEY

SIX = datetime(2026, 9, 27, 6, tzinfo=UTC)


def _decisions(spark, target, incoming):
    merged = merge.merge_states(batch(spark, *target), batch(spark, *incoming))
    return sorted((r.decision, r.available_rooms) for r in merged.collect())


def test_decisions(spark):
    later = SIX + timedelta(hours=1)
    base = row(rooms=7)
    assert _decisions(spark, [], [base]) == [("insert", 7)]
    assert _decisions(spark, [base], [base]) == [("replay", 7)]
    assert _decisions(spark, [base], [row(rooms=5, at=later)]) == [("update", 5)]
    assert _decisions(spark, [row(rooms=5, at=later)], [base]) == [("stale", 5)]
    assert _decisions(spark, [base], [row(rooms=8)]) == [("conflict", 7)]
    assert _decisions(spark, [base], []) == [("keep", 7)]
    assert _decisions(spark, [base], [base, base]) == [("duplicate_in_batch", 7)]
    assert _decisions(spark, [base, base], [base]) == [("duplicate_in_table", 7)]
    assert _decisions(spark, [row(hotel="Hotel")], [row(hotel="hotel", rooms=9)]) == [
        ("insert", 9), ("keep", 7),
    ]


def test_conflict_probe(spark):
    target, bad = batch(spark, row(rooms=7)), batch(spark, row(rooms=8))
    assert merge.has_conflict(target, bad).first().has_conflict
    assert not merge.has_conflict(target, target).first().has_conflict
    assert listed(merge.same_time_conflicts(target, bad).select("hotel_id")) == [("demo",)]


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.tuples(st.integers(0, 3), st.integers(0, 4)), min_size=1, max_size=25
    ),
    st.randoms(),
)
def test_fold_is_order_free_and_merge_is_idempotent(spark, seen, random):
    """Each (hotel, minute) has one value, so equal times never disagree."""
    observed = {
        (h, m): row(hotel=f"h{h}", rooms=h * 10 + m, at=SIX + timedelta(minutes=m)) for h, m in seen
    }
    rows = list(observed.values())
    expected = {}
    for (h, m), r in observed.items():
        if h not in expected or m > expected[h][0]:
            expected[h] = (m, r[3])
    folded = dedup.latest(batch(spark, *rows))
    assert {r.hotel_id: r.available_rooms for r in folded.collect()} == {
        f"h{h}": value for h, (_, value) in expected.items()
    }
    random.shuffle(rows)
    cut = len(rows) // 2
    parts = [dedup.latest(batch(spark, *part)).select(COLUMNS) for part in (rows[:cut], rows[cut:])]
    one, two = (
        merge.merge_states(a, b).select(COLUMNS) for a, b in (parts, parts[::-1])
    )
    assert listed(one) == listed(two) == listed(folded.select(COLUMNS))
    again = merge.merge_states(one, parts[1])
    assert listed(again.select(COLUMNS)) == listed(one)
    assert {r.decision for r in again.collect()} <= {"replay", "stale", "keep"}


def test_collapse_and_conflicts(spark):
    rows = batch(spark, row(), row(), row(hotel="b", rooms=1), row(hotel="b", rooms=2))
    agreed = dedup.identical_collapsed(rows, KEY)
    assert [(r.hotel_id, r.available_rooms, r.records) for r in agreed.collect()] == [("demo", 7, 2)]
    assert [(r.hotel_id, r.low, r.high) for r in dedup.conflicting(rows, KEY).collect()] == [("b", 1, 2)]
    assert dedup.duplicate_keys(rows).count() == 2
