"""Landing intermediate tables in the folder that all executors share."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from staytally import fs


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which all executors must reach."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return configured.rstrip("/")


class Workspace:
    """One run's private folder. Landed tables outlive lost executors and cut lineage."""

    def __init__(self, spark: SparkSession, run_id: str | None = None) -> None:
        self.spark = spark
        self.run_id = run_id or uuid4().hex
        self.path = f"{shared_folder(spark)}/staytally-{self.run_id}"

    def land(self, frame: DataFrame, label: str) -> DataFrame:
        """Write once, read back: what is checked later is what is published later."""
        target = f"{self.path}/{label}"
        frame.write.mode("errorifexists").parquet(target)
        return self.spark.read.schema(frame.schema).parquet(target)

    def land_counted(
        self, frame: DataFrame, label: str, counts: dict[str, str]
    ) -> tuple[DataFrame, dict]:
        """Land, and gather aggregates of the same rows in the same pass.

        The rows are counted by the tasks that write them, each once however often it is tried.
        """
        seen = Observation()
        columns = [F.expr(text).alias(name) for name, text in counts.items()]
        return self.land(frame.observe(seen, *columns), label), seen.get

    def close(self) -> None:
        fs.delete(self.spark, self.path)


def spread(frame: DataFrame, *keys: str) -> DataFrame:
    """Spread few rows that are about to become many over all shuffle partitions.

    The number is explicit because AQE would otherwise merge partitions by the
    small size that the rows have before they grow.
    """
    partitions = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frame.repartition(partitions, *keys)
