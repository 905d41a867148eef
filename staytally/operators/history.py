"""Reads over the retained daily history, ordering, and set operations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from staytally.functions.scalars import day_literal
from staytally.operators.ranking import global_positions
from staytally.schema import CELL, KEY
from staytally.workspace import Workspace


def union_snapshots(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of every snapshot, columns matched by name."""
    for other in others:
        first = first.unionByName(other)
    return first


def history(table: DataFrame, first_day: date, last_day: date) -> DataFrame:
    """Snapshot days in a range; the filter prunes partitions of the table."""
    return table.where(F.col("snapshot_date").between(day_literal(first_day), day_literal(last_day)))


def as_of(table: DataFrame, day: date) -> DataFrame:
    """For each cell its row of the last snapshot day not after ``day``.

    One row per key is a precondition, so the newest day decides alone.
    """
    past = table.where(F.col("snapshot_date") <= day_literal(day))
    return past.groupBy(*CELL).agg(
        F.max_by("available_rooms", "snapshot_date").alias("available_rooms"),
        F.max_by("observed_at", "snapshot_date").alias("observed_at"),
        F.max("snapshot_date").alias("snapshot_date"),
    )


def newest_day(table: DataFrame, days: list[date], day: date) -> DataFrame:
    """The rows of the last of the listed snapshot days that is not after ``day``.

    Every published day is complete by itself. The day is a scalar subquery over the listing,
    answered while the query runs, and prunes the scan to that day's folder.
    """
    spark = table.sparkSession
    listed = spark.createDataFrame([(held.isoformat(),) for held in days], "day string")
    return spark.sql(
        f"""
        SELECT * FROM {{table}} WHERE snapshot_date = (
            SELECT max(CAST(day AS DATE)) FROM {{listed}} WHERE day <= '{day.isoformat()}')
        """,
        table=table,
        listed=listed,
    )


def rows_per_day(table: DataFrame) -> DataFrame:
    return table.groupBy("snapshot_date").agg(F.count("*").alias("rows"))


def canonical_order(rows: DataFrame) -> DataFrame:
    """Total order by key. For results; writes only need ``clustered``."""
    return rows.orderBy(*KEY)


def ordered_positions(rows: DataFrame, workspace: Workspace) -> DataFrame:
    """Rows with their 0-based ``position`` in the total order: by key, then time and count."""
    return global_positions(rows, [*KEY, "observed_at", "available_rooms"], workspace)


def clustered(rows: DataFrame) -> DataFrame:
    """Order inside each partition: enough for compact files and row-group pruning."""
    return rows.sortWithinPartitions("snapshot_date", "hotel_id", "room_type_id", "stay_date")
