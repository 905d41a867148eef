"""Documents to training shards: five stages, each on all that the one before kept.

Each stage is a function of (spark, docs, sf_dir). Its result is written and read again as the
next one's documents; all but the last return the columns of documents. A stage frees the tables
that the stage before it needed, whose output must be written by then.

Every stage takes null, empty and very long texts, rows without an id, repeated rows and ids, empty
tables, and further columns of any name: inside a stage these are renamed, so none can clash.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from staytally.llm import cotraining, decontaminate, minhash, mixing, tokens
from staytally.llm.scratch import Scratch, collected

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
_opened: list[Scratch] = []


def _stage(function: Stage) -> Stage:
    """Free what the last stage opened, and keep further columns out of the way of the operators."""

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _opened:
            _opened.pop().close()
        names = docs.columns
        others = {name: f"other{i}x{uuid4().hex}" for i, name in enumerate(names) if name not in COLUMNS}
        with collected(_opened):
            out = function(spark, docs.withColumnsRenamed(others), sf_dir)
        back = {own: name for name, own in others.items() if own in out.columns}
        return out.withColumnsRenamed(back)

    return run


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifiers reject as bad or as toxic go. An empty or null text is
    judged by its source and language; where no labels of both kinds are given, all stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = cotraining.score(docs, cotraining.train(docs, labels))
    return scored.where(cotraining.kept()).select(docs.columns)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays. Rows of one id are one document; rows
    without an id stay, and so do texts without words."""
    found = minhash.near_duplicates(docs)
    gone = found.where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out, row by row; a document of nothing else goes. Null and empty
    texts and those without words stay as they are; ``n_chars`` follows the text."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    cut = decontaminate.remove_passages(docs, benchmark)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.char_length("text").cast(kind))
    return cut.select(docs.columns)


@_stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's text as often as the mix takes it: whole copies, and the runs of words that stand at
    the ends of a shard's quota, cut out with the space between them. Rows without words take none."""
    scratch = Scratch(spark, "mixture")
    docs = scratch.land(docs.withColumn("_row", F.monotonically_increasing_id()), "rows", "zstd")
    mixed = mixing.mix_sources(docs, keep=("_row", "pieces"))
    pieces = mixed.select("_row", "size", F.explode("pieces").alias("_piece")).select(
        "_row",
        (F.col("_piece.stop") - F.col("_piece.start") < F.col("size")).alias("_cut"),
        F.col("_piece.start").alias("_start"),
        F.col("_piece.stop").alias("_stop"),
    )
    taken = docs.join(pieces, "_row")
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    some = F.slice(words, (F.col("_start") + 1).cast("int"), (F.col("_stop") - F.col("_start")).cast("int"))
    taken = taken.withColumn("text", F.when(F.col("_cut"), F.array_join(some, "")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        taken = taken.withColumn("n_chars", F.when(F.col("_cut"), length).otherwise(F.col("n_chars")))
    return taken.select([c for c in docs.columns if c != "_row"])


@_stage
def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Binary shards in training order, and their manifest. A null or empty text is one sequence of
    the end id; a row without an id keeps its null. Columns beside id and text are not read."""
    return tokens.write_token_shards(docs)


STAGES = [
    ("quality classifier", quality),
    ("near-dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("token shards", token_shards),
]

#: A trained classifier and hashed choices are not SQL; tests hold the stages to plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs, landed = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for number, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if number == len(STAGES) - 1:
            return out
        docs = scratch.land(out, name.replace(" ", "-"))
        if landed is not None:
            scratch.drop(landed)
        landed = docs
    raise AssertionError("there are stages")
