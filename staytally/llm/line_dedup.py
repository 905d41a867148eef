"""Operator 8: lines that many documents hold stay only in the last of them.

Built-in expressions only. Rows are landed with a row number; the keys' hashes (128 bits wide) are
exploded with their positions and landed too. A key's documents are counted on pairs (hash,
document), so a line that a third of all documents hold is spread by document and pre-aggregated
before it meets on its hash. The positions that go come back by row number, and the rest of a text
is put together by position: linear in a document's lines, whatever holds how many of them.

Nulls: a null text is one empty line and comes back as an empty text. A null id is no
document in the counts and never the largest; its lines follow the others' verdict. Rows of
one id are one document in the counts, and each comes back; they never meet in one group, however many
they are. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from staytally.llm.scratch import Scratch

MIN_CHARS = 20
MIN_DOCS = 3
_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else.

    ``lower`` is many times faster than ``translate``; it is the same where the text is ASCII,
    and where its other characters have no lower form.
    """
    lower = F.lower(text)
    others = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    same = (F.octet_length(text) == F.char_length(text)) | (F.lower(others) == others)
    return F.when(same, lower).otherwise(F.translate(text, _UPPER, _LOWER))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hash(line: Column, min_chars: int) -> Column:
    """Hash of a line's key; null where the key is too short to be judged."""
    key = F.btrim(line, F.lit(_SPACE))
    return F.when(F.char_length(key) >= min_chars, F.unhex(F.md5(ascii_lower(key))))


def drop_repeated_lines(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped and the text of the kept lines."""
    scratch = Scratch(docs.sparkSession, "lines")
    docs = docs.select(
        F.col(id).alias("doc_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("rid")
    )
    docs = scratch.land(docs, "texts", "zstd")
    hashed = F.transform(_lines(F.col("text")), lambda line: _hash(line, min_chars))
    lines = docs.select("rid", "doc_id", F.posexplode(hashed).alias("pos", "key")).where("key IS NOT NULL")
    lines = scratch.land(lines, "lines")
    keys = (
        lines.select("key", "doc_id")
        .distinct()
        .groupBy("key")
        .agg(F.count("doc_id").alias("docs"), F.max("doc_id").alias("last"))
        .where(F.col("docs") >= min_docs)
        .select("key", "last")
    )
    drops = (
        lines.join(keys, "key")
        .where(~F.col("doc_id").eqNullSafe(F.col("last")))
        .groupBy("rid")
        .agg(F.collect_list("pos").alias("gone"))
    )
    joined = docs.join(drops, "rid", "left").withColumn("lines", _lines(F.col("text")))
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    kept = F.transform(places, lambda at: F.get("lines", at))
    kept = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(kept)
    return joined.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("text"),
    )
