from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from staytally.functions import scalars as S


def _texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def _map(spark, values, rule):
    rows = _texts(spark, values).select("value", rule("value").alias("out")).collect()
    return {r.value: r.out for r in rows}


def test_identifiers(spark):
    """Each ASCII character alone, then inside, then at the end; and the longest length."""
    letters = [chr(c) for c in range(128)]
    first = {c for c in letters if c.isalnum()}
    later = first | set("_.-")
    expected = {c: c in first for c in letters}
    expected |= {f"m{c}m": c in later for c in letters} | {f"m{c}": c in later for c in letters}
    expected |= {"k" * n: 1 <= n <= 128 for n in (0, 127, 128, 129)}
    expected |= {"ß": False, "m\u0660": False, None: False}
    assert _map(spark, list(expected), S.is_identifier) == expected


def test_strict_dates(spark):
    """Every day of a leap and a common year, days beyond each month, and forms beside the one."""
    days = [date(year, 1, 1) + timedelta(days=n) for year in (2023, 2024) for n in range(365)]
    expected = {day.isoformat(): day for day in [*days, date.min, date.max]}
    for year in (2023, 2024):
        for month in range(0, 14):
            for day in (0, 29, 30, 31, 32):
                expected.setdefault(f"{year}-{month:02}-{day:02}", None)
    expected["2024-12-31"] = date(2024, 12, 31)
    for month in (1, 3, 5, 7, 8, 10):
        expected[f"2024-{month:02}-31"] = date(2024, month, 31)
    text = "2023-05-06"
    forms = [text[:-1], text + "0", " " + text, text + "\t", text + "Z", "+" + text, text.replace("-", "/")]
    forms += [text.replace("-", ""), text[2:], "0000-05-06", "10000-05-06", "2023-126", "٢٠٢٣-05-06", "", None]
    expected |= dict.fromkeys(forms)
    assert _map(spark, list(expected), S.strict_date) == expected


def test_instants_from_text(spark):
    def rule(value):
        return S.wall_text(S.utc_wall_of_text(value))

    good = {
        "2026-09-27T02:00:00+02:00": "2026-09-27T00:00:00.000000Z",
        "2026-09-27T06:00:00Z": "2026-09-27T06:00:00.000000Z",
        "2026-09-27 06:00Z": "2026-09-27T06:00:00.000000Z",
        "2026-03-08T02:30:00.000001Z": "2026-03-08T02:30:00.000001Z",
        "2026-11-01T01:30:00-04:00": "2026-11-01T05:30:00.000000Z",
        "2026-11-01T01:30:00-05:00": "2026-11-01T06:30:00.000000Z",
        "2026-09-27T00:10:00.25+23:59": "2026-09-26T00:11:00.250000Z",
        "0001-01-01T00:00:00Z": "0001-01-01T00:00:00.000000Z",
    }
    bad = ["2026-09-27T06:00:00", "not-a-date", "2026-02-30T06:00:00Z", "2026-09-27T25:00:00Z",
           "0001-01-01T00:00:00+01:00", "9999-12-31T23:30:00-01:00", "2026-09-27Z",
           "2026-09-27T06:00:00+2", "2026-09-27T06:00:00Z\n", "", None]
    assert _map(spark, [*good, *bad], rule) == {**good, **{v: None for v in bad}}


@pytest.mark.parametrize(
    "stamp",
    [
        datetime(2026, 9, 27, 23, 59, 59, 999999, UTC),
        datetime(2026, 3, 8, 7, 30, tzinfo=UTC),
        datetime(2026, 11, 1, 5, 30, tzinfo=UTC),
        datetime(1969, 12, 31, 23, 59, 59, 1, UTC),
    ],
)
def test_instants_do_not_depend_on_the_session_zone(spark, stamp):
    frame = spark.range(1).select(F.lit(stamp).alias("t"))
    out = frame.select(
        S.instant_text("t").alias("text"),
        S.snapshot_day("t").alias("day"),
        (S.instant_of_wall(S.utc_wall("t")) == F.col("t")).alias("same"),
    ).first()
    assert out.text == stamp.isoformat(timespec="microseconds").replace("+00:00", "Z")
    assert (out.day, out.same) == (stamp.date(), True)
