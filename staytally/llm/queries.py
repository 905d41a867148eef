"""The registered queries of the subpackage: each operator on its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from staytally.llm import (
    context_tree,
    cotraining,
    decontaminate,
    fill_middle,
    forest,
    line_dedup,
    merkle,
    minhash,
    mixing,
    page_crf,
    passage_dedup,
    tokens,
    warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(text) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        _sha256(F.array_join(F.array_sort("item_ids"), ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.write_token_shards(_table(spark, sf_dir, "documents"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op5_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    judges = cotraining.train(documents, _table(spark, sf_dir, "labels"))
    scored = cotraining.score(documents.select("doc_id", "text", "source", "lang"), judges)
    return scored.select(
        "doc_id", "p_text", "p_page", "p_good", "p_toxic", cotraining.kept().alias("kept")
    )


def op6_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score_texts(_table(spark, sf_dir, "documents"))


def op7_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(_table(spark, sf_dir, "embeddings"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(_table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", _sha256(F.col("text")).alias("kept_sha256")
    )


def op9_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = passage_dedup.drop_repeated_passages(_table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_words", "n_removed", _sha256(F.col("text")).alias("kept_sha256")
    )


def op10_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_crf.extract(_table(spark, sf_dir, "pages"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    proven = merkle.manifest(_table(spark, sf_dir, "documents"), tampered=merkle.every_third())
    folded = proven.withColumn("folded_root", merkle.fold(F.col("checked"), "proof"))
    return folded.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest("proof").alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType.simpleString()
    found = warc.read_archives(warc.write_archives(pages), id_type=kind)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_middle.fill_in_middle(_table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        _sha256(F.col("output")).alias("output_sha256"),
        _sha256(fill_middle.restored("output", "form")).alias("restored_sha256"),
    )


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_token_shards": op2_token_shards,
    "op3_near_dedup": op3_near_dedup,
    "op4_mixing": op4_mixing,
    "op5_cotraining": op5_cotraining,
    "op6_context_tree": op6_context_tree,
    "op7_forest": op7_forest,
    "op8_line_dedup": op8_line_dedup,
    "op9_passage_dedup": op9_passage_dedup,
    "op10_page_text": op10_page_text,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_warc_packages": op12_warc_packages,
    "op13_fill_middle": op13_fill_middle,
}
