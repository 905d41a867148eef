"""Strict scalar rules as columns: identifiers, dates, instants, canonical text.

Nothing here depends on the session time zone.
"""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, functions as F

_UNIX_EPOCH = datetime(1970, 1, 1, tzinfo=UTC)

# The accepted text forms. ``\z`` and not ``$``, which lets a newline through.
IDENTIFIER = r"\A[A-Za-z0-9][A-Za-z0-9_.-]{0,127}\z"
CALENDAR_DATE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
OFFSET_TIMESTAMP = (
    r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?"
    r"(Z|[+-]([01][0-9]|2[0-3]):[0-5][0-9])\z"
)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")


def day_literal(day: date) -> Column:
    """DATE literal; ``lit`` would pass through a calendar that differs before 1582."""
    return F.lit(day.isoformat()).cast("date")


def on_days(day: Column | str, days: list[date]) -> Column:
    """Membership in a list of days; as literals they prune partitions statically."""
    return _col(day).isin([day_literal(value) for value in days])


def instant_literal(stamp: datetime) -> Column:
    """TIMESTAMP literal of a zoned datetime, exact for every year."""
    return F.timestamp_micros(F.lit((stamp - _UNIX_EPOCH) // timedelta(microseconds=1)))


def is_identifier(value: Column | str) -> Column:
    """True only for a well-formed identifier; NULL counts as malformed."""
    return F.coalesce(_col(value).rlike(IDENTIFIER), F.lit(False))


def strict_date(value: Column | str) -> Column:
    """DATE for an existing ``YYYY-MM-DD`` day of years 1 to 9999, else NULL."""
    value = _col(value)
    well_formed = value.rlike(CALENDAR_DATE) & ~value.startswith("0000")
    return F.when(well_formed, value.try_cast("date"))


def utc_wall(instant: Column | str) -> Column:
    """TIMESTAMP to the UTC wall clock (TIMESTAMP_NTZ)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(instant)), _epoch())


def instant_of_wall(wall: Column | str) -> Column:
    """UTC wall clock (TIMESTAMP_NTZ) to TIMESTAMP."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), _col(wall)))


def snapshot_day(instant: Column | str) -> Column:
    """UTC calendar day of a TIMESTAMP."""
    return utc_wall(instant).cast("date")


def utc_wall_of_text(value: Column | str) -> Column:
    """UTC wall clock of text that carries an offset; NULL for naive or impossible times."""
    value = _col(value)
    zulu = value.endswith("Z")
    clock = F.when(zulu, F.substr(value, F.lit(1), F.length(value) - 1)).otherwise(
        F.substr(value, F.lit(1), F.length(value) - 6)
    )
    tail = F.right(value, F.lit(6))
    minutes = F.substr(tail, F.lit(2), F.lit(2)).try_cast("int") * 60 + F.substr(
        tail, F.lit(5), F.lit(2)
    ).try_cast("int")
    shift = F.when(zulu, F.lit(0)).when(tail.startswith("-"), minutes).otherwise(-minutes)
    wall = F.when(
        value.rlike(OFFSET_TIMESTAMP) & ~value.startswith("0000"),
        F.timestamp_add("MINUTE", shift, clock.try_cast("timestamp_ntz")),
    )
    return F.when(F.year(wall).between(1, 9999), wall)


def instant_of_text(value: Column | str) -> Column:
    """TIMESTAMP of text that carries an offset, else NULL."""
    return instant_of_wall(utc_wall_of_text(value))


def wall_text(wall: Column | str) -> Column:
    """Fixed-width UTC text with microseconds, so that text order is time order."""
    wall = _col(wall)
    micros = F.pmod(F.timestamp_diff("MICROSECOND", _epoch(), wall), F.lit(1_000_000))
    seconds = F.translate(F.substr(wall.cast("string"), F.lit(1), F.lit(19)), " ", "T")
    return F.concat(seconds, F.lit("."), F.lpad(micros.cast("string"), 6, "0"), F.lit("Z"))


def instant_text(instant: Column | str) -> Column:
    return wall_text(utc_wall(instant))
