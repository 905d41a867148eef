"""Operator 11: a Merkle manifest of a table, with a proof for every row.

A row's leaf is the hash of its fields, each with its length, so that no two rows read alike. The
leaves of a tree (one per language) ascend by id; every ``ARITY`` consecutive nodes become their
hash until one is left, and the trees' roots likewise give the root of the table.

Ranks are written as digit columns, the lowest first. Inside a block of ``ARITY ** LEVELS`` leaves
the digits are grouped away one after another: each grouping nests the child structs of a node,
in order, into a struct with the node's digest. All groupings of a block share one shuffle. The
blocks' digests are the nodes of the next round, until each tree has one. On the way back a
block's own proof travels as one more row of the block and rides through the same groupings, so
no join is needed: transforms set each child's siblings beside it and explodes take the nested
structs apart, block by block, down to the leaves.

A language that a third of all rows share is many blocks; rows without an id, or alike in
everything, are cut across ranges by their place in the input when they are ranked. Texts are
read once; what is landed and shuffled are ids and digests.

Nulls: a null field is ``-`` in the leaf. A null language is a tree of its own and comes first.
Rows without an id come first in their tree. Rows of one id are leaves of their own, ordered by
leaf. An empty text is not a null one. An empty table gives no rows. Columns beside the five are
neither read nor hashed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from staytally.llm.line_dedup import ascii_lower
from staytally.llm.scratch import Scratch
from staytally.operators.ranking import number_rows

ARITY, LEVELS = 8, 4
_BITS = 3  # of a rank's digit
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_PATH = "array<struct<before: string, after: string>>"


def digest_of(*texts: Column) -> Column:
    """Lower-case hex SHA-256 of the texts one after another."""
    return F.sha2(F.concat(*texts), 256)


def field_text(value: Column) -> Column:
    """``-`` for null, else the number of bytes, a colon and the value."""
    value = value.cast("string")
    marked = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
    return F.coalesce(marked, F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return digest_of(*(field_text(value) for value in values))


def fold(leaf: Column, proof: Column | str) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda held, step: digest_of(step["before"], held, step["after"]))


def proof_digest(proof: Column | str) -> Column:
    """Hash of all siblings, from the leaf's run up to the root's, left to right."""
    steps = F.transform(proof, lambda step: F.concat(step["before"], step["after"]))
    return F.sha2(F.array_join(steps, ""), 256)


def _grouped(nodes: DataFrame, above: DataFrame | None) -> DataFrame:
    """One row per (tree, block): total, digest, the nested nodes and what came from above.

    ``nodes`` are (tree, total, rank, digest, item), ``above`` is (tree, rank, up) with the block
    as its rank. A level at which the tree has one node already passes it on as it is.
    """
    digits = [f"d{level}" for level in range(LEVELS)]
    rows = nodes.select(
        "tree",
        F.shiftright("rank", _BITS * LEVELS).alias("block"),
        "total",
        F.lit(None).cast("void" if above is None else above.schema["up"].dataType).alias("up"),
        *(
            F.shiftright("rank", _BITS * level).bitwiseAND(F.lit(ARITY - 1)).alias(digit)
            for level, digit in enumerate(digits)
        ),
        F.struct(
            F.col("rank").bitwiseAND(F.lit(ARITY - 1)).alias("digit"), "digest", "item"
        ).alias("node"),
    )
    if above is None:
        rows = rows.drop("up")
    else:
        riders = above.select("tree", F.col("rank").alias("block"), "up")
        rows = rows.unionByName(riders, allowMissingColumns=True)
    rows = rows.repartition("tree", "block")
    for level in range(LEVELS):
        rest = digits[level + 1 :]
        held = [F.max("total").alias("total"), F.sort_array(F.collect_list("node")).alias("children")]
        if above is not None:
            held.append(F.any_value("up", F.lit(True)).alias("up"))
        grouped = rows.groupBy("tree", "block", *rest).agg(*held)
        digests = F.col("children.digest")
        digest = F.when(F.col("total") <= ARITY**level, F.get(digests, F.lit(0)))
        digest = digest.otherwise(F.sha2(F.array_join(digests, ""), 256))
        if level == LEVELS - 1:
            return grouped.withColumn("digest", digest)
        node = F.struct(F.col(rest[0]).alias("digit"), digest.alias("digest"), "children")
        # The group of the row from above has no digits and no children.
        rows = grouped.withColumn("node", F.when(F.size("children") > 0, node)).drop("children")
    raise AssertionError("a block has levels")


def _up(nodes: DataFrame) -> DataFrame:
    """The blocks of ``nodes`` as nodes of the next round."""
    blocks = _grouped(nodes.withColumn("item", F.lit(None).cast("boolean")), None)
    span = ARITY**LEVELS
    total = F.floor((F.col("total") + (span - 1)) / span)
    return blocks.select(
        "tree",
        total.alias("total"),
        F.col("block").alias("rank"),
        "digest",
        F.lit(None).cast("boolean").alias("item"),
    )


def _beside(child: Column, at: Column) -> Column:
    """A child with the digests of its siblings before and after it."""
    digests = F.col("children.digest")
    step = F.struct(
        F.array_join(F.slice(digests, F.lit(1), at), "").alias("before"),
        F.array_join(F.slice(digests, at + 2, F.lit(ARITY)), "").alias("after"),
    )
    return F.struct(child.alias("child"), step.alias("step"))


def _down(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """``tree, rank, item, digest`` and ``up`` of every node, with the node's own steps before the
    steps that its block brought from above."""
    rows = _grouped(nodes, above).withColumnRenamed("block", "rank")
    for level in reversed(range(LEVELS)):
        placed = F.transform("children", _beside)
        rows = rows.select("tree", "total", "rank", "up", F.explode(placed).alias("e"))
        steps = F.when(
            F.col("total") > ARITY**level, F.array_prepend("up.steps", F.col("e.step"))
        ).otherwise(F.col("up.steps"))
        rank = F.shiftleft("rank", _BITS) + F.col("e.child.digit")
        last = ["e.child.item", "e.child.digest"] if level == 0 else ["e.child.children"]
        up = F.col("up").withField("steps", steps)
        rows = rows.select("tree", "total", rank.alias("rank"), up.alias("up"), *last)
    return rows.drop("total")


def _climb(leaves: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """The leaves, the digests of their blocks, of the blocks' blocks, and so on; the last has one
    node per tree."""
    rounds = [leaves]
    most = leaves.agg(F.max("total").alias("total")).first().total or 0
    while most > 1:
        rounds.append(scratch.land(_up(rounds[-1]), f"round-{len(rounds)}"))
        most = -(-most // ARITY**LEVELS)
    return rounds


def _descend(rounds: list[DataFrame], above: DataFrame, scratch: Scratch) -> DataFrame:
    """``tree, rank, item, digest, up`` of the leaves, given ``up`` of each tree's root."""
    for number, nodes in reversed(list(enumerate(rounds[:-1]))):
        found = _down(nodes, above)
        if number:
            above = scratch.land(found.select("tree", "rank", "up"), f"above-{number}")
    if len(rounds) == 1:
        found = rounds[0].join(above, ["tree", "rank"])
    return found.select("tree", "rank", "item", "digest", "up")


def _numbered(rows: DataFrame, group: str, order: list[str], scratch: Scratch) -> DataFrame:
    ranked = number_rows(rows, group, order, scratch)
    return ranked.select(F.col(group).alias("tree"), "total", F.col("position").alias("rank"), "digest", "item")


def manifest(docs: DataFrame, *, tampered: Column | None = None) -> DataFrame:
    """Per row: doc_id, lang, rank, leaf, subroot, root, proof and ``checked``, the leaf to verify.

    ``proof`` holds a step for each level at which nodes were hashed: the digests before and after
    the row's own. ``tampered`` tells in which rows ``checked`` is the leaf of a lower-cased text;
    without it ``checked`` is the leaf. Where they are told by the id, see ``every_third``.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "merkle")
    values = [F.col(name) for name in FIELDS]
    leaf = leaf_of(*values)
    forged = F.lit(None).cast("string")
    if tampered is not None:
        forged = F.when(tampered, leaf_of(*values[:-1], ascii_lower(F.col("text"))))
    leaves = docs.select(
        # Before every other tree is the one without a language.
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        leaf.alias("digest"),
        F.struct(F.col("doc_id").alias("doc_id"), forged.alias("forged")).alias("item"),
        F.col("doc_id").alias("_id"),
        F.monotonically_increasing_id().alias("_place"),
    )
    leaves = _numbered(leaves, "tree", ["_id", "digest", "_place"], scratch)
    leaves = scratch.land(leaves, "leaves")
    rounds = _climb(leaves, scratch)
    subroots = rounds[-1].select(
        F.lit("").alias("all"), "tree", "digest", F.struct("tree").alias("item")
    )
    trees = scratch.land(_numbered(subroots, "all", ["tree"], scratch), "trees")
    tops = _climb(trees, scratch)
    start = F.struct(
        F.lit(None).cast("string").alias("subroot"),
        F.col("digest").alias("root"),
        F.array().cast(_PATH).alias("steps"),
    )
    above = tops[-1].select("tree", "rank", start.alias("up"))
    above = _descend(tops, above, scratch).select(
        F.col("item.tree").alias("tree"),
        F.lit(0).cast("bigint").alias("rank"),
        F.col("up").withField("subroot", F.col("digest")).alias("up"),
    )
    found = _descend(rounds, scratch.land(above, "roots"), scratch)
    return found.select(
        F.col("item.doc_id").alias("doc_id"),
        F.when(F.col("tree") != "", F.substr("tree", F.lit(2))).alias("lang"),
        "rank",
        F.col("digest").alias("leaf"),
        F.col("up.subroot").alias("subroot"),
        F.col("up.root").alias("root"),
        F.col("up.steps").alias("proof"),
        F.coalesce("item.forged", "digest").alias("checked"),
    )


def every_third(id: str = "doc_id") -> Column:
    """Rows whose id's unsigned CRC-32, of its decimal text, is a multiple of three."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 3 == 0, F.lit(False))
