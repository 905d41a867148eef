"""The few file-system calls a path-based table needs, on whatever store Spark uses."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    store, target = _path(spark, path)
    return store.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Entry names directly under ``path``; one listing, not recursive."""
    store, target = _path(spark, path)
    if not store.exists(target):
        return []
    return sorted(entry.getPath().getName() for entry in store.listStatus(target))


def delete(spark: SparkSession, path: str) -> None:
    store, target = _path(spark, path)
    store.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None without the file."""
    store, target = _path(spark, path)
    if not store.exists(target):
        return None
    stream = store.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in the place of another in one rename: readers see the old or the new."""
    fresh = f"{path}.{uuid4().hex}"
    store, source = _path(spark, fresh)
    stream = store.create(source, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    kind = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context = hadoop.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(store.makeQualified(source), store.makeQualified(hadoop.Path(path)), options)
