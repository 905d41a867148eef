"""Small result tables: run summary, reconciliation, run statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from staytally.operators.ranking import weighted_ranks
from staytally.workspace import Workspace


def run_summary(batch: DataFrame, sink: str) -> DataFrame:
    """One row per snapshot day of the run."""
    return batch.groupBy("snapshot_date").agg(
        F.lit("ok").alias("status"),
        F.count("*").alias("rows_processed"),
        F.lit(sink).alias("sink"),
    )


def reconcile(table: DataFrame, expected: int | Column) -> DataFrame:
    """Rows per snapshot day against the expected number."""
    expected = expected if isinstance(expected, Column) else F.lit(expected)
    counted = table.groupBy("snapshot_date").agg(F.count("*").alias("rows"))
    return counted.withColumn("expected_rows", expected.cast("bigint")).withColumn(
        "reconciled", F.col("rows") == F.col("expected_rows")
    )


def run_statistics(
    measurements: DataFrame, by: str, value: str, workspace: Workspace
) -> DataFrame:
    """Exact median, minimum and maximum of a measurement per group.

    Equal values are counted before the first shuffle, and the distinct ones are
    ranked across ranges: ``percentile`` would hold a whole group in one task.
    """
    known = measurements.select(by, value).where(F.col(value).isNotNull())
    counted = known.groupBy(by, value).agg(F.count("*").alias("copies"))
    ranked = weighted_ranks(counted, by, value, "copies", workspace)

    def at(rank: Column) -> Column:
        return F.max(F.when(rank.between(F.col("first"), F.col("last")), F.col(value)))

    lower, upper = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)
    return ranked.groupBy(by).agg(
        F.max("total").alias("runs"),
        ((at(lower) + at(upper)) / 2).alias("median_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    )
