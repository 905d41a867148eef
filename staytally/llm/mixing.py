"""Operator 4: how many words of each document a mix of sources takes.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating, and share ``SHARE``
times all words; a target stops at ``LIMIT`` times its source's words and the excess is shared
again. Equal blocks of ``BLOCK`` words are then apportioned by the highest quotients
target / (2 seats - 1) (Sainte-Laguë): first to sources, then to each source's shards. A shard
holds some ``SHARD_WORDS`` words of seeded documents of one source, so a hot source is many
shards. Its documents stand in a seeded order and are cut into blocks; its quota takes every
block as often as it goes round, and the rest as a run of blocks from a seeded one.

A shard's last block is shorter, so a source misses its target by a block or less a shard.
Documents are dealt and ordered by their ids alone, so reruns agree, whatever the partitions. Only an
id (or null) that over ``SHARED`` rows have says too little to deal by: its rows are dealt by the number
that they are landed with, and spread over their source's shards. The same number orders rows of one id
and size. There reruns agree on the same input files.

Nulls: a null source is a source, a null id a document, a null text has no words. Documents
without words take none. Repeated rows are documents of their own. Empty tables give empty results.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from staytally.llm.scratch import Scratch

WEIGHTS = (5, 2, 1)
SHARE, LIMIT = 1.5, 2
BLOCK, SHARD_WORDS, SHARD_DOCS, SHARED = 16, 1 << 20, 1 << 16, 1 << 10
SEED = 42


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT
) -> DataFrame:
    """(source, source_size, docs, target): one row a source, by one sort of the sources.

    Ordered by the weight that fills them, the sources filled to their limit come first; from
    the first that is not, what is left is shared by weight.
    """
    sources = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("docs")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights) + 1
    weight = F.element_at(F.array(*map(F.lit, weights)), place.cast("int")).cast("double")
    sources = sources.withColumn("weight", weight).withColumn("full", limit * F.col("source_size"))
    by_fill = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = by_fill.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = by_fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(every) * share
    used = F.sum("full").over(upto) - F.col("full")
    open_weight = F.sum("weight").over(every) - F.sum("weight").over(upto) + F.col("weight")
    sources = sources.withColumn("level", (total - used) / open_weight)
    is_open = F.col("full") > F.col("level") * F.col("weight")
    level = F.min(F.when(is_open, F.struct(F.col("full") / F.col("weight"), "level"))).over(every)
    return sources.withColumn("common", level.getField("level")).select(
        "source",
        "source_size",
        "docs",
        F.when(is_open, F.col("common") * F.col("weight")).otherwise(F.col("full")).cast("double").alias("target"),
    )


def apportion(parties: DataFrame, group: list[str], key: list[str], votes: str, seats: str) -> DataFrame:
    """Sainte-Laguë seats of each party: column ``quota`` beside the parties' own.

    A group's ``seats`` (the same in its rows) go to the highest votes / (2 s - 1); equal
    quotients to the smaller key. Seats above a divisor that is surely too high are counted at
    once; only some two seats a party around the last winning quotient are ranked.
    """
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    total, n = F.sum(votes).over(whole), F.count("*").over(whole)
    share = F.col(votes) / F.col("_total")
    parties = parties.withColumns({"_total": total.cast("double"), "_n": n}).withColumns(
        {
            f"_{name}": F.when(
                F.col("_total") > 0, F.floor(share * F.greatest(F.lit(0.0), at) + 0.5)
            ).otherwise(0)
            for name, at in (
                ("sure", F.col(seats) - F.col("_n") / 2 - 1),
                ("most", F.col(seats) + F.col("_n") / 2 + 1),
            )
        }
    )
    parties = parties.withColumn("_left", F.col(seats) - F.sum("_sure").over(whole))
    named = [*group, *key]
    ranked = Window.partitionBy(*(group or [F.lit(0)])).orderBy(F.desc("_quotient"), *named)
    extra = (
        parties.where("_most > _sure")
        .withColumn("_seat", F.explode(F.sequence(F.col("_sure") + 1, F.col("_most"))))
        .withColumn("_quotient", F.col(votes) / (2 * F.col("_seat") - 1))
        .withColumn("_rank", F.row_number().over(ranked))
        .where("_rank <= _left")
        .groupBy(*[F.col(c).alias(f"_{c}") for c in named])
        .agg(F.count("*").alias("_extra"))
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in named]
    out = parties.join(extra, same, "left").withColumn(
        "quota", F.col("_sure") + F.coalesce("_extra", F.lit(0))
    )
    return out.drop("_total", "_n", "_sure", "_most", "_left", "_extra", *[f"_{c}" for c in named])


def _overlap(low: Column, high: Column) -> Column:
    begin = F.greatest("begin", low)
    return F.greatest(F.lit(0), F.least(F.col("begin") + F.col("size"), high) - begin)


def _piece(low: Column, high: Column) -> Column:
    begin = F.greatest(F.lit(0), low - F.col("begin")).cast("long")
    return F.struct(
        begin.alias("start"), (begin + _overlap(low, high)).cast("long").alias("stop")
    )


def _pieces() -> Column:
    whole = F.struct(F.lit(0).cast("long").alias("start"), F.col("size").alias("stop"))
    rest = F.array(_piece(F.col("low"), F.col("high")), _piece(F.lit(0), F.col("wrap")))
    found = F.concat(F.array_repeat(whole, F.col("rounds").cast("int")), rest)
    found = F.filter(found, lambda x: x.getField("stop") > x.getField("start"))
    return F.when(F.col("rounds").isNotNull(), found).otherwise(F.array().cast("array<struct<start:bigint,stop:bigint>>"))


def deal(sizes: DataFrame, sources: DataFrame, seed: int, shared: int, scratch: Scratch) -> DataFrame:
    """Rows with the shard of their source, and their place along it. Ids of many rows are counted after
    a map-side combine; there are at most rows / ``shared`` of them."""
    often = sizes.groupBy(F.col("doc_id").alias("_often")).agg(F.count("*").alias("_n"))
    often = scratch.land(often.where(F.col("_n") > shared), "often")
    by_id = F.xxhash64(F.lit(seed), "doc_id")
    place = F.when(F.col("_n").isNull(), by_id).otherwise(F.xxhash64(F.lit(seed), "doc_id", "rid"))
    dealt = sizes.join(often, F.col("doc_id").eqNullSafe(F.col("_often")), "left").withColumn("place", place)
    return dealt.drop("_often", "_n").join(
        sources, F.col("source").eqNullSafe(F.col("_source"))
    ).withColumn("shard", F.pmod(F.xxhash64("place"), F.col("shards")))


def mix_sources(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    block: int = BLOCK,
    seed: int = SEED,
    shared: int = SHARED,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, taken, and the columns of ``keep``.

    ``keep`` may name ``pieces``, which is made here: the runs of words (start, stop) that are taken,
    one after another, ``taken`` words in all.
    """
    pieces, keep = "pieces" in keep, tuple(c for c in keep if c != "pieces")
    scratch = Scratch(docs.sparkSession, "mixing")
    sizes = scratch.land(
        docs.select(
            F.col(id).alias("doc_id"),
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
            F.monotonically_increasing_id().alias("rid"),
            *keep,
        ),
        "sizes",
    )
    sources = source_targets(sizes, weights, share).withColumn(
        "shards",
        F.greatest(
            F.lit(1),
            F.ceil(F.col("source_size") / SHARD_WORDS),
            F.ceil(F.col("docs") / SHARD_DOCS),
        ),
    )
    every = Window.partitionBy(F.lit(0))
    sources = sources.withColumn("seats", F.round(F.sum("target").over(every) / block).cast("long"))
    sources = apportion(sources, [], ["source"], "target", "seats")
    sources = scratch.land(sources.drop("seats"), "sources").withColumnRenamed("source", "_source")

    dealt = deal(sizes, sources, seed, shared, scratch)
    shards = dealt.groupBy("source", "shard").agg(
        F.sum("size").alias("words"), F.first("quota").alias("seats")
    )
    blocks = F.ceil(F.col("words") / block)
    shards = apportion(shards.where("words > 0"), ["source"], ["shard"], "words", "seats")
    quota = F.least("quota", LIMIT * blocks)
    shards = shards.select(
        F.col("source").alias("_s"),
        F.col("shard").alias("_k"),
        F.floor(quota / blocks).alias("rounds"),
        (F.pmod(F.xxhash64(F.lit(seed), "source", "shard"), blocks) * block).alias("low"),
        (quota % blocks * block).alias("run"),
        "words",
    ).withColumns(
        {
            "high": F.least(F.col("low") + F.col("run"), F.col("words")),
            "wrap": F.greatest(
                F.lit(0), F.col("low") + F.col("run") - F.ceil(F.col("words") / block) * block
            ),
        }
    )
    along = Window.partitionBy("source", "shard").orderBy("place", "doc_id", "size", "rid")
    along = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.withColumn("begin", F.sum("size").over(along) - F.col("size"))
    placed = placed.join(
        shards,
        F.col("source").eqNullSafe(F.col("_s")) & (F.col("shard") == F.col("_k")),
        "left",
    )
    taken = (
        F.col("size") * F.col("rounds")
        + _overlap(F.col("low"), F.col("high"))
        + _overlap(F.lit(0), F.col("wrap"))
    )
    placed = placed.withColumn("pieces", _pieces()) if pieces else placed
    keep += ("pieces",) if pieces else ()
    return placed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.coalesce(taken, F.lit(0)).cast("long").alias("taken"),
        *keep,
    )
