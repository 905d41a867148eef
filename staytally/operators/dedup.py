"""Repeated keys: collapse when identical, report when not, fold to the newest."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from staytally.schema import CELL, KEY


def collapse(rows: DataFrame, key: list[str] = CELL) -> DataFrame:
    """One row per key: ``low``, ``high`` and the number of ``records``.

    All three aggregates combine before the shuffle, so a key with very many
    copies crosses it once per task.
    """
    return rows.groupBy(*key).agg(
        F.min("available_rooms").alias("low"),
        F.max("available_rooms").alias("high"),
        F.count("*").alias("records"),
    )


def identical_collapsed(rows: DataFrame, key: list[str] = CELL) -> DataFrame:
    """Keys whose copies all agree, as single rows. A key without any count is in neither this nor
    ``conflicting``: such rows are refused before, by ``required columns``."""
    agreed = collapse(rows, key).where("low = high")
    return agreed.select(*key, F.col("low").alias("available_rooms"), "records")


def conflicting(rows: DataFrame, key: list[str] = CELL) -> DataFrame:
    """Keys whose copies disagree."""
    return collapse(rows, key).where("low <> high")


def duplicate_keys(rows: DataFrame, key: list[str] = KEY) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("copies")).where("copies > 1")


_WORD = 1 << 64
# Added to times and counts, so that neither is negative when they are packed into one number.
_TIME_FLOOR, _COUNT_FLOOR = 1 << 62, 1 << 63


def latest(rows: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Newest observation per key; the order in which batches arrived is irrelevant.

    Of copies with equal time the larger count stands, so the result never depends on row order;
    ``conflicting`` over ``key + ["observed_at"]`` tells whether there are such. Time and count are
    packed into one number of 38 digits, time first: its maximum is a plain hash aggregate with a
    map-side combine, where a struct would be sorted. A row without a time or count is no
    observation.
    """
    wall = rows.schema["observed_at"].dataType.typeName() == "timestamp_ntz"
    epoch = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
    micros = f"timestampdiff(MICROSECOND, {epoch}, observed_at)" if wall else "unix_micros(observed_at)"
    packed = (
        f"(CAST({micros} AS DECIMAL(20, 0)) + {_TIME_FLOOR}BD) * {_WORD}BD"
        f" + (CAST(available_rooms AS DECIMAL(20, 0)) + {_COUNT_FLOOR}BD)"
    )
    newest = rows.groupBy(*key).agg(F.max(F.expr(f"CAST({packed} AS DECIMAL(38, 0))")).alias("_packed"))
    micros = f"CAST((_packed div {_WORD}BD) - {_TIME_FLOOR} AS BIGINT)"
    observed = f"timestampadd(MICROSECOND, {micros}, {epoch})" if wall else f"timestamp_micros({micros})"
    return newest.where("_packed IS NOT NULL").selectExpr(
        *key,
        f"CAST((_packed % {_WORD}BD) - {_COUNT_FLOOR}BD AS BIGINT) AS available_rooms",
        f"{observed} AS observed_at",
    )
