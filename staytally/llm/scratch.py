"""Tables between the steps of an operator, in the folder that all executors share."""

from __future__ import annotations

import atexit
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from staytally import fs
from staytally.workspace import shared_folder

#: Spark's setting by which a finished query's shuffle files are deleted at once.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_collecting: list[list] = []


@contextmanager
def collected(opened: list) -> Iterator[None]:
    """Gather what is opened inside, for a caller who knows when it may go."""
    _collecting.append(opened)
    try:
        yield
    finally:
        _collecting.pop()


class Scratch:
    """One run's own folder. A landed table cuts lineage and outlives lost executors; the shuffles
    that led to it are deleted once it stands.

    ``drop`` frees a table early; the folder goes when the driver's Python ends, because
    results are lazy and may read it until then, or when the caller closes it. The setting that
    frees shuffles is the session's while a table is written: one run at a time per session.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.path = f"{shared_folder(spark)}/llm-{label}-{uuid4().hex}"
        self._tables = 0
        atexit.register(self.close)
        if _collecting:
            _collecting[-1].append(self)

    def land(self, frame: DataFrame, label: str, compression: str = "snappy", **options) -> DataFrame:
        self._tables += 1
        target = f"{self.path}/{self._tables:03d}-{label}"
        before = self.spark.conf.get(_FREE_SHUFFLES)
        self.spark.conf.set(_FREE_SHUFFLES, "true")
        try:
            frame.write.options(**options).parquet(target, compression=compression)
        finally:
            self.spark.conf.set(_FREE_SHUFFLES, before)
        landed = self.spark.read.schema(frame.schema).parquet(target)
        landed.llm_path = target
        return landed

    def drop(self, landed: DataFrame) -> None:
        fs.delete(self.spark, landed.llm_path)

    def close(self) -> None:
        """Delete the folder; only for a caller who no longer reads any result of this run."""
        atexit.unregister(self.close)
        context = self.spark.sparkContext
        if getattr(context, "_jsc", None) is not None:
            fs.delete(self.spark, self.path)
