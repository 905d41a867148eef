"""Ranks inside groups of any size, without sorting a group in one task.

Rows are range-partitioned by group and order, so a large group is cut across
many ranges; each range is ranked on its own and shifted by what its group holds
in earlier ranges. ``order`` should tell the rows of a group apart: rows that
agree in all of it share a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from staytally.workspace import Workspace


def _in_ranges(
    rows: DataFrame, group: list[str], order: list[str], workspace: Workspace
) -> DataFrame:
    """Landed rows with their ascending ``_row`` number and ``_range``.

    The one landing is written by the range shuffle itself; Spark samples the ranges from the same
    rows. It is landed because a recomputed range could number equal rows differently.
    """
    keys = [*group, *order]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered = ranged.withColumn("_row", F.monotonically_increasing_id())
    return workspace.land(numbered, f"ranges-{'-'.join(keys)}").withColumn(
        "_range", F.shiftright("_row", 33)
    )


def _totals(ranges: DataFrame, group: str, weight: Column) -> DataFrame:
    """Per (group, range): weight in earlier ranges, weight of the group, first row.

    The window runs over one row per range that a group touches, not over its rows.
    """
    spans = ranges.groupBy(group, "_range").agg(
        F.sum(weight).alias("_held"), F.min("_row").alias("_first")
    )
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return spans.select(
        group,
        "_range",
        "_first",
        F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_earlier"),
        F.sum("_held").over(whole).alias("total"),
    )


def number_rows(
    rows: DataFrame, group: str, order: list[str], workspace: Workspace
) -> DataFrame:
    """Add each row's 0-based ``position`` within its group and the group's ``total``."""
    ranges = _in_ranges(rows, [group], order, workspace)
    totals = _totals(ranges, group, F.lit(1).cast("bigint"))
    return (
        ranges.join(totals, [group, "_range"])
        .withColumn("position", F.col("_row") - F.col("_first") + F.col("_earlier"))
        .drop("_row", "_range", "_first", "_earlier")
    )


def global_positions(rows: DataFrame, order: list[str], workspace: Workspace) -> DataFrame:
    """Add each row's 0-based ``position`` in the order of the whole table.

    A range's rows are numbered where they lie; what stands before a range is the prefix sum of
    one count per range, so no task sees more than its own range.
    """
    ranges = _in_ranges(rows, [], order, workspace)
    # One row per range: at most the number of shuffle partitions, whatever the table holds.
    held = ranges.groupBy("_range").agg(F.count("*").alias("_held"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("_range", F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_before"))
    inside = F.col("_row") - F.shiftleft("_range", 33)
    return (
        ranges.join(F.broadcast(starts), "_range")
        .withColumn("position", F.col("_before") + inside)
        .drop("_row", "_range", "_before")
    )


def weighted_ranks(
    values: DataFrame, group: str, value: str, weight: str, workspace: Workspace
) -> DataFrame:
    """Add ``first`` and ``last``, the 0-based ranks a value's copies take, and ``total``."""
    ranges = _in_ranges(values, [group], [value], workspace)
    totals = _totals(ranges, group, F.col(weight)).drop("_first")
    so_far = Window.partitionBy(group, "_range").orderBy("_row").rowsBetween(
        Window.unboundedPreceding, 0
    )
    ends = F.col("_earlier") + F.sum(weight).over(so_far)
    return (
        ranges.join(totals, [group, "_range"])
        .withColumn("last", ends - 1)
        .withColumn("first", F.col("last") - F.col(weight) + 1)
        .drop("_row", "_range", "_earlier")
    )
