"""Operator 3: near-duplicate groups by MinHash, banding and connected components.

1. One pass gives each document its set size, a digest of its words, and ``ROWS * BANDS``
   minima under universal hash functions. Equal texts become one class at once.
2. Classes that agree in a band share a bucket. Each round, a bucket that still spans several
   components proposes one centre, the class with the most links so far, with each class of
   another component: never all pairs. Proposals pass on signatures, then are confirmed on
   full sets, and components are found anew.
3. A round joins each bucket's members once, whatever a bucket holds. Once the pairs left across
   components are ``PAIRS_A_MEMBER`` for a bucket's member on average, or a round lessens them by
   no more than that or by less than a tenth, each such bucket compares its classes in blocks:
   signatures and full sets travel a class and block, never a pair, and only links come out. No
   link between different texts that share a bucket is lost.

Buckets that hold exactly the same classes are one bucket (told by 128 bits of their members).

Two documents at the similarity bound share no bucket with a chance of (1 - 0.8^5)^32, 3 in a
million; the signature bound lies eight standard deviations below the link's.

Nulls: a null text or one without words has an empty set and is linked with nothing; a row
with a null id stands alone, without a component, and is kept. Rows of one id are one document:
links of any of them hold for all. Repeated rows come back repeatedly, empty tables empty.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from staytally.llm import words as W
from staytally.llm.components import components
from staytally.llm.scratch import Scratch

SHINGLE, PERCENT = 5, 80
ROWS, BANDS = 5, 32
#: Below this share of equal minima a pair is not looked at on full sets.
SIGNATURE_SLACK = 0.25
#: Comparisons in blocks that cost less than another round of centres.
PAIRS_A_MEMBER = 64
#: Classes and shingles of a block on average; two blocks are compared by one task.
BLOCK, BLOCK_SHINGLES = 256, 1 << 19

_RANDOM = np.random.default_rng(7_919)
_MULTIPLY = _RANDOM.integers(0, 2**63, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RANDOM.integers(0, 2**63, ROWS * BANDS, dtype=np.uint64)
_CACHED = 1 << 16
_SLICE = 2 << 20

_SKETCH = "doc_id bigint, n bigint, digest binary, signature binary"
_SETS = "digest binary, shingles binary"


def _shingles(found: W.Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, text after text, and where each text's begin."""
    hashes, counts = found.hashes(), found.counts()
    rolled, at = W.rolled(hashes, found.first, width)
    texts = found.text_of()
    of = texts[at]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for j in range(width - 1):
            longer = counts[short] > j
            own = found.first[short[longer]] + j
            whole[longer] = whole[longer] * W.BASE + hashes[own] + np.uint64(j + 1)
        rolled, of = np.concatenate([rolled, W.mix(whole)]), np.concatenate([of, short])
    order = np.lexsort((rolled, of))
    rolled, of = rolled[order], of[order]
    new = np.ones(len(rolled), bool)
    new[1:] = (rolled[1:] != rolled[:-1]) | (of[1:] != of[:-1])
    return rolled[new], np.searchsorted(of[new], np.arange(len(counts) + 1))


def _digests(found: W.Words) -> list[bytes]:
    """Of each text's words, one space between."""
    word = W.SPACED[found.data]
    kept = word.copy()
    kept[1:] |= word[:-1]
    moved = np.cumsum(kept) - kept
    raw = np.where(word, found.data, np.uint8(0x20))[kept].tobytes()
    out = []
    for i, j in zip(found.first.tolist(), found.first[1:].tolist(), strict=False):
        text = raw[moved[found.starts[i]] : moved[found.ends[j - 1] - 1] + 1] if j > i else b""
        out.append(hashlib.blake2b(text, digest_size=16).digest())
    return out


def _minima(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One row a text with shingles: its minimum under each hash function."""
    sizes = np.diff(first)
    full = np.flatnonzero(sizes)
    out = np.empty((len(full), ROWS * BANDS), np.uint32)
    i = 0
    while i < len(full):  # few enough at a time to stay in the processor's cache
        j = max(i + 1, int(np.searchsorted(first, first[full[i]] + _CACHED)))
        j = max(i + 1, int(np.searchsorted(full, j)))
        low = first[full[i]]
        values = shingles[low : first[full[min(j, len(full)) - 1] + 1]]
        begins = first[full[i:j]] - low
        for k in range(ROWS * BANDS):
            hashed = values * _MULTIPLY[k]
            hashed += _ADD[k]
            out[i:j, k] = np.minimum.reduceat(hashed, begins) >> np.uint64(32)
        i = j
    return out


def _sketch(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text", _SLICE):
            found = W.scan(batch.column("text"), W.SPACED, True)
            shingles, first = _shingles(found, width)
            sizes = np.diff(first)
            signatures: list[bytes | None] = [None] * len(sizes)
            for k, row in zip(np.flatnonzero(sizes).tolist(), _minima(shingles, first), strict=True):
                signatures[k] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(_digests(found), pa.binary()),
                    pa.array(signatures, pa.binary()),
                ],
                names=["doc_id", "n", "digest", "signature"],
            )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text", _SLICE):
            found = W.scan(batch.column("text"), W.SPACED, True)
            shingles, first = _shingles(found, width)
            raw = shingles.tobytes()
            sets = [raw[8 * i : 8 * j] for i, j in zip(first.tolist(), first[1:].tolist(), strict=False)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(_digests(found), pa.binary()), pa.array(sets, pa.binary())],
                names=["digest", "shingles"],
            )

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            pairs = zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)
            for x, y in pairs:
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def _alike(slack: float, percent: int):
    least = (percent / 100 - slack) * ROWS * BANDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(
                    -1, ROWS * BANDS
                )
                for k in ("x", "y")
            )
            good = (x == y).sum(1) >= least
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return run


def _linked(sets: list[bytes], signatures: np.ndarray, can: np.ndarray, percent: int):
    """Pairs (i, j) of classes, i < j, that are links; can[i, j] is false where none is sought."""
    sizes = np.array([len(s) // 8 for s in sets])
    first = np.cumsum(sizes) - sizes
    _, ids = np.unique(np.frombuffer(b"".join(sets), np.uint64), return_inverse=True)
    held = np.zeros(len(ids), bool)
    least = (percent / 100 - SIGNATURE_SLACK) * ROWS * BANDS
    for i in range(len(sets) - 1):
        later = i + 1 + np.flatnonzero(can[i, i + 1 :])
        later = later[(signatures[later] == signatures[i]).sum(1) >= least]
        if not len(later):
            continue
        own = ids[first[i] : first[i] + sizes[i]]
        held[own] = True
        at = first[later[0]]
        both = np.add.reduceat(held[ids[at:]], first[later[0] :] - at, dtype=np.int64)
        held[own] = False
        both = both[later - later[0]]
        for j in later[100 * both >= percent * (sizes[i] + sizes[later] - both)].tolist():
            yield i, j


def _compare(percent: int):
    """Rows come sorted by group (bucket, low, high): the classes of one or two blocks."""

    def links(group: pa.Table) -> Iterator[tuple[bytes, bytes]]:
        if group.num_rows < 2:
            return
        n, root, own = (group.column(k).to_numpy() for k in ("n", "root", "own"))
        can = (root[:, None] != root) & (100 * n[:, None] >= percent * n) & (100 * n >= percent * n[:, None])
        if group.column("low")[0] != group.column("high")[0]:
            can &= own[:, None] != own
        if not can.any():
            return
        signatures = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint32)
        digest = group.column("digest").to_pylist()
        sets = group.column("shingles").to_pylist()
        for i, j in _linked(sets, signatures.reshape(len(n), -1), can, percent):
            yield min(digest[i], digest[j]), max(digest[i], digest[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: set) -> pa.RecordBatch:
            a, b = zip(*found, strict=True) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

        carried = None  # the last group may go on in the next batch
        for batch in W.slices(batches, "shingles"):
            table = pa.Table.from_batches([batch])
            if carried is not None:
                table = pa.concat_tables([carried, table])
            keys = [table.column(k).to_numpy() for k in ("bucket", "low", "high")]
            new = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
            cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
            carried = table.slice(cuts[-1])
            yield out({p for i, j in zip(cuts, cuts[1:], strict=False) for p in links(table.slice(i, j - i))})
        if carried is not None:
            yield out(set(links(carried)))

    return run


def _with_both(pairs: DataFrame, side: DataFrame, value: str, *more: str) -> DataFrame:
    """Values of both ends of the pairs, as x and y (and n_x, n_y)."""
    x = side.select(F.col("digest").alias("a"), F.col(value).alias("x"), *[F.col(m).alias(f"{m}_x") for m in more])
    y = side.select(F.col("digest").alias("b"), F.col(value).alias("y"), *[F.col(m).alias(f"{m}_y") for m in more])
    return pairs.join(x, "a").join(y, "b")


def _mixed(spread: DataFrame, of: Column) -> DataFrame:
    """An aggregate of each bucket that spans several components."""
    found = spread.groupBy("bucket").agg(of, F.min("root").alias("l"), F.max("root").alias("h"))
    return found.where("l <> h").drop("l", "h")


class _Linker:
    """Confirms proposed pairs of classes, and finds components of the links."""

    def __init__(self, classes, sets, percent, scratch) -> None:
        self.classes, self.sets, self.percent, self.scratch = classes, sets, percent, scratch

    def links(self, proposed: DataFrame) -> DataFrame:
        percent = self.percent
        sized = _with_both(proposed, self.classes, "signature", "n").where(
            f"100 * n_x >= {percent} * n_y and 100 * n_y >= {percent} * n_x"
        )
        alike = sized.select("a", "b", "x", "y").mapInArrow(
            _alike(SIGNATURE_SLACK, percent), "a binary, b binary"
        )
        linked = _with_both(alike, self.sets, "shingles").select("a", "b", "x", "y")
        linked = linked.mapInArrow(_confirm(percent), "a binary, b binary")
        return self.scratch.land(linked, "links")

    def edges(self, links: DataFrame) -> DataFrame:
        reps = self.classes.select("digest", "rep")
        return (
            links.join(reps.select(F.col("digest").alias("a"), F.col("rep").alias("ra")), "a")
            .join(reps.select(F.col("digest").alias("b"), F.col("rep").alias("rb")), "b")
            .select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        )

    def roots(self, members: DataFrame, edges: DataFrame) -> DataFrame:
        """(node, root) of the components, given the buckets and the edges known before."""
        land = self.scratch.land
        limit, before = members.count(), None
        roots = components(edges, self.scratch)
        links = tested = used = None
        while True:
            of = self.classes.select("digest", "rep", "n").join(
                roots.withColumnRenamed("node", "rep"), "rep", "left"
            )
            of = of.select("digest", "n", F.coalesce("root", "rep").alias("root"))
            spread = land(members.join(of, "digest"), "spread")
            counts = spread.groupBy("bucket", "root").agg(F.count("*").cast("double").alias("c"))
            counts = counts.groupBy("bucket").agg((F.sum("c") ** 2 - F.sum(F.col("c") ** 2)).alias("c"))
            pairs = counts.agg(F.sum("c") / 2).first()[0]
            if not pairs:
                return roots
            known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            cost = PAIRS_A_MEMBER * limit
            if before is not None and (min(pairs, before - pairs) <= cost or pairs > 0.9 * before):
                new = self._across(spread)
                return components(known.unionByName(self.edges(new)), self.scratch)
            centres = self._centres(spread, links, used)
            used = centres if used is None else land(used.unionByName(centres), "used")
            proposed = spread.join(centres, "bucket").where("root <> centre_root")
            proposed = proposed.select(
                F.least("digest", "centre").alias("a"), F.greatest("digest", "centre").alias("b")
            ).distinct()
            if tested is not None:
                proposed = proposed.join(tested, ["a", "b"], "left_anti")
            proposed = land(proposed, "proposed")
            new = self.links(proposed)
            tested = proposed if tested is None else tested.unionByName(proposed)
            links = new if links is None else links.unionByName(new)
            roots = components(known.unionByName(self.edges(new)), self.scratch)
            before = pairs

    def _centres(self, spread: DataFrame, links: DataFrame | None, used: DataFrame | None) -> DataFrame:
        """Of each bucket of several components the class with the most links that was no centre
        there yet."""
        if links is None:
            spread = spread.withColumns({"degree": F.lit(0).cast("long"), "was": F.lit(None).cast("boolean")})
        else:
            degrees = links.select(F.explode(F.array("a", "b")).alias("digest"))
            degrees = degrees.groupBy("digest").agg(F.count("*").alias("degree"))
            spread = spread.join(degrees, "digest", "left").fillna(0, ["degree"])
            was = used.select("bucket", F.col("centre").alias("digest"), F.lit(True).alias("was"))
            spread = spread.join(was, ["bucket", "digest"], "left")
        free = F.when(F.col("was").isNull(), F.struct("degree", "digest", "root"))
        best = _mixed(spread, F.max(free).alias("best")).where("best is not null")
        best = best.select(
            "bucket", F.col("best.digest").alias("centre"), F.col("best.root").alias("centre_root")
        )
        return self.scratch.land(best, "centres")

    def _across(self, spread: DataFrame) -> DataFrame:
        """All links between components within a bucket; a bucket of several blocks is compared
        block by block."""
        blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES))
        blocks = _mixed(spread, blocks.alias("blocks"))
        rows = spread.join(blocks, "bucket").withColumn("own", F.expr("pmod(xxhash64(digest), blocks)"))
        rows = rows.join(self.classes.select("digest", "signature"), "digest").join(self.sets, "digest")
        rows = rows.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        rows = rows.select(
            "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
            "own", "digest", "n", "root", "signature", "shingles",
        )
        group = ("bucket", "low", "high")
        found = rows.repartition(*group).sortWithinPartitions(*group)
        found = found.mapInArrow(_compare(self.percent), "a binary, b binary")
        return self.scratch.land(found.distinct(), "links")


def near_duplicates(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (least id reachable by links) and kept."""
    scratch = Scratch(docs.sparkSession, "minhash")
    docs = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketch = scratch.land(docs.mapInArrow(_sketch(shingle), _SKETCH), "sketch")
    nodes = sketch.where("n > 0 and doc_id is not null")

    reps = nodes.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    classes = scratch.land(
        nodes.join(reps.withColumn("doc_id", F.col("rep")), ["digest", "doc_id"])
        .dropDuplicates(["digest", "doc_id"])
        .select("digest", "rep", "n", "signature"),
        "classes",
    )
    width = 4 * ROWS
    band = [
        F.xxhash64(F.lit(k), F.substring("signature", k * width + 1, width)) for k in range(BANDS)
    ]
    bands = classes.select("digest", F.explode(F.array(*band)).alias("bucket"))
    shared = bands.groupBy("bucket").agg(
        F.count("*").alias("held"),
        F.bit_xor(F.xxhash64("digest")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "digest")).alias("y"),
    )
    shared = shared.where("held > 1").groupBy("held", "x", "y").agg(F.min("bucket").alias("bucket"))
    members = scratch.land(bands.join(shared.select("bucket"), "bucket", "left_semi"), "members")

    wanted = members.select("digest").distinct()
    ids = classes.join(wanted, "digest", "left_semi").select(F.col("rep").alias("doc_id")).distinct()
    sets = docs.join(ids, "doc_id", "left_semi").select("text").mapInArrow(_sets(shingle), _SETS)
    sets = sets.join(wanted, "digest", "left_semi").dropDuplicates(["digest"])
    sets = scratch.land(sets, "sets")

    # Rows of one id with different words are one document.
    twice = nodes.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    twice = nodes.join(twice.where("low <> high"), "doc_id").select("doc_id", "digest")
    same = twice.join(reps, "digest").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    roots = _Linker(classes, sets, percent, scratch).roots(members, same)

    named = reps.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("digest").alias("class"), F.coalesce("root", "rep").alias("root")
    )
    linked = (F.col("digest") == F.col("class")) & (F.col("n") > 0) & F.col("doc_id").isNotNull()
    component = F.coalesce("root", "doc_id")
    return sketch.join(named, linked, "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
