"""Operator 6: context-tree weighting over bytes, and the code length it gives each text.

A text is its lower-cased words, one space between, and an end byte 0xFF; ``DEPTH`` zero bytes
stand before it. A byte is eight binary decisions, and a node of the tree is a context of 0 to
``DEPTH`` bytes with the decisions so far. Counts come from the training texts. A node weighs its
own Krichevsky-Trofimov block probability against the product of its children's weighted
ones; the same weights mix the estimates of all depths when a byte is predicted. A node that was
never seen predicts one half.

Counting: texts are landed in chunks of ``CHUNK_BYTES``. A chunk's distinct (DEPTH + 1)-byte strings
are listed with their counts, and Spark sums them. All contexts with the same last two bytes are
one group in which the tree is built from the leaves up; a group of over ``BLOCK_NODES`` nodes is
cut by one more byte. The driver sees only sums over groups, for the nodes above them.

Scoring: each group builds its part again, knows the nodes above, and answers every string that
any text holds. A chunk's strings are joined to their answers, which meet its texts by its number.
So no task and not the driver holds more of the tree than a group or the strings of a chunk.

The base score needs each word's count. The most frequent ``HOT_WORDS`` words are broadcast;
all others are joined by their 64-bit hash, so no frequent word is a join key.

Nulls: a null text is empty (the end alone), a null id counts as the empty text in the split.
Repeated rows and ids are texts of their own. Without training texts every byte costs eight bits
and the base score is 0. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from staytally.llm import words as W
from staytally.llm.scratch import Scratch

DEPTH = 5
FOLDS, HELD_FOLD = 7, 2
BLOCK_NODES = 2_000_000
HOT_WORDS = 1 << 19
CHUNK_BYTES = 32 << 20
_MERGE = 1 << 22
_SLOTS = 22
_GRAM, _WORD = 0, 1
#: The end token's key among word hashes; a word's hash is shifted clear of it.
_END_WORD = -1
_ROOT = "depth int, key bigint, n0 double, n1 double, weighted double"


def _texts(found: W.Words, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts with their zeros and ends, and where each text's own bytes begin."""
    counts = found.counts()
    sizes = found.ends - found.starts
    per_text = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(np.add.reduceat(np.r_[sizes + 1, 0], found.first[:-1]) * (counts > 0), out=per_text[1:])
    # A word's room is its bytes and a space; the last one's space becomes the end byte, which an
    # empty text also has.
    room = per_text[1:] - per_text[:-1] + (counts == 0) + depth
    begin = np.cumsum(room) - room + depth
    data = np.zeros(int(room.sum()), np.uint8)
    text = found.text_of()
    offset = np.cumsum(sizes + 1) - (sizes + 1) - per_text[text]
    at = begin[text] + offset
    data[at + sizes] = 0x20
    skip = np.repeat(np.cumsum(sizes) - sizes, sizes)
    within = np.arange(int(sizes.sum())) - skip
    data[np.repeat(at, sizes) + within] = found.data[np.repeat(found.starts, sizes) + within]
    data[begin + room - depth - 1] = 0xFF
    return data, begin


def _grams(data: np.ndarray, begin: np.ndarray, depth: int) -> np.ndarray:
    """The byte and its context at each own byte of the texts: nearest context byte at bit 8."""
    own = np.ones(len(data), bool)
    for back in range(1, depth + 1):
        own[begin - back] = False
    key = np.zeros(len(data), np.int64)
    for back in range(depth + 1):
        key[back:] |= data[: len(data) - back].astype(np.int64) << (8 * back)
    return key[own]


def _counted(values: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    value, count = np.concatenate(values), np.concatenate(counts)
    order = np.argsort(value)
    value, count = value[order], count[order]
    head = np.flatnonzero(np.r_[True, value[1:] != value[:-1]]) if len(value) else []
    return (value[head], np.add.reduceat(count, head)) if len(value) else (value, count)


class _Tally:
    def __init__(self, kind: int, chunk: int) -> None:
        self.kind, self.chunk, self.values, self.counts, self.held = kind, chunk, [], [], 0

    def add(self, keys: np.ndarray, counted: bool = True) -> None:
        keys = np.sort(keys)
        if len(keys):
            head = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            self.values.append(keys[head])
            self.counts.append(np.diff(np.r_[head, len(keys)]) * counted)
            self.held += len(head)

    def rows(self, least: int) -> Iterator[pa.RecordBatch]:
        """Everything counted so far, if that is at least so much after merging."""
        if self.held >= max(least, 1):
            value, count = _counted(self.values, self.counts)
            self.values, self.counts, self.held = [value], [count], len(value)
            if len(value) * 2 >= least:
                self.values, self.counts, self.held = [], [], 0
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(value), self.kind, np.int32)),
                        pa.array(np.full(len(value), self.chunk)),
                        pa.array(value),
                        pa.array(count),
                    ],
                    names=["kind", "chunk", "key", "n"],
                )


def _word_keys(found: W.Words) -> np.ndarray:
    return (found.hashes() >> np.uint64(1)).astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a number each, and the number of the chunk that they are scored in."""
    chunk = row = TaskContext.get().partitionId() << 40
    held = 0
    for batch in W.slices(batches, "text"):
        n = batch.num_rows
        columns = [*batch.columns, pa.array(np.arange(row, row + n)), pa.array(np.full(n, chunk))]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "rid", "chunk"])
        row, held = row + n, held + batch.column("text").nbytes
        if held >= CHUNK_BYTES:
            chunk, held = chunk + 1, 0


def _count(depth: int):
    """Strings of each chunk (none counted in held-out texts) and words of the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, words = _Tally(_GRAM, -1), _Tally(_WORD, -1)
        for batch in W.slices(batches, "text"):
            found = W.scan(batch.column("text"), W.SPACED, True)
            train = ~batch.column("held_out").to_numpy(zero_copy_only=False)
            chunk = batch.column("chunk").to_numpy()
            data, begin = _texts(found, depth)
            keys, n_bytes = _grams(data, begin, depth), np.diff(np.r_[begin, len(data) + depth]) - depth
            counted, ends = np.repeat(train, n_bytes), np.r_[0, np.cumsum(n_bytes)]
            cuts = np.r_[0, np.flatnonzero(np.diff(chunk)) + 1, len(chunk)]
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if i == j:
                    continue
                if chunk[i] != grams.chunk:
                    yield from grams.rows(0)
                    grams = _Tally(_GRAM, int(chunk[i]))
                own = slice(ends[i], ends[j])
                grams.add(keys[own][counted[own]])
                grams.add(keys[own][~counted[own]], counted=False)
            own = _word_keys(found)[np.repeat(train, found.counts())]
            words.add(np.r_[own, np.full(int(train.sum()), _END_WORD)])
            for tally in (grams, words):
                yield from tally.rows(_MERGE)
        for tally in (grams, words):
            yield from tally.rows(0)

    return run


def _log_gamma(x: np.ndarray) -> np.ndarray:
    low = sum(np.log(x + i) for i in range(8))
    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - low


def _block_probability(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1) - np.log(np.pi)


def _summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[head], *(np.add.reduceat(v[order], head) for v in values)


def _leaves(gram: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, zeros, ones) of the deepest nodes: key is the context and the decisions so far."""
    symbol, context = gram & 0xFF, gram >> 8
    keys, zeros, ones = [], [], []
    for level in range(8):
        bit = (symbol >> (7 - level)) & 1
        keys.append((context << 8) | (1 << level) | (symbol >> (8 - level)))
        zeros.append(np.where(bit == 0, count, 0))
        ones.append(np.where(bit == 1, count, 0))
    return _summed(np.concatenate(keys), np.concatenate(zeros).astype(float), np.concatenate(ones).astype(float))


def _up(key, n0, n1, weighted, depth: int, down_to: int):
    """Nodes of each depth from ``depth`` to ``down_to``, given the sums over the children (None
    for leaves): (depth, key, log odds of the node's own estimate, P(one), n0, n1, weighted)."""
    while True:
        own = _block_probability(n0, n1)
        one = (n1 + 0.5) / (n0 + n1 + 1)
        if weighted is None:
            odds, both = np.full(len(key), np.inf), own
        else:
            odds, both = own - weighted, np.logaddexp(own, weighted) - np.log(2)
        yield depth, key, odds, one, n0, n1, both
        if depth == down_to:
            return
        depth -= 1
        context = (key >> 8) & ((1 << (8 * depth)) - 1)
        key, n0, n1, weighted = _summed((context << 8) | (key & 0xFF), n0, n1, both)


def _own_nodes(group: pa.Table, depth: int):
    """Nodes of a group of contexts from ``depth`` to the group's root."""
    count = group.column("n").to_numpy()
    seen = np.flatnonzero(count)
    if len(seen):
        gram, root = group.column("key").to_numpy()[seen], group.column("root")[0].as_py()
        yield from _up(*_leaves(gram, count[seen]), None, depth, root)


def _roots(depth: int):
    def run(group: pa.Table) -> pa.Table:
        level, key, n0, n1, weighted = 0, np.zeros(0, np.int64), *[np.zeros(0)] * 3
        for level, key, _, _, n0, n1, weighted in _own_nodes(group, depth):
            pass
        columns = [np.full(len(key), level, np.int32), key, n0, n1, weighted]
        return pa.table([*map(pa.array, columns)], names=["depth", "key", "n0", "n1", "weighted"])

    return run


def _answers(held, depth: int):
    """log10 of the probability of each string's byte, for all strings of a group."""

    def run(group: pa.Table) -> pa.Table:
        levels = dict(held.value)
        for level, key, odds, one, *_ in _own_nodes(group, depth):
            levels[level] = (key, _weight(odds), one)
        root = group.column("root")[0].as_py()
        tree = Tree(depth, levels, group.column("contexts")[0].as_py(), root)
        gram = group.column("key").to_numpy()
        parts = [tree.log10(gram[i : i + (1 << 18)]) for i in range(0, len(gram), 1 << 18)]
        return pa.table([pa.array(gram), pa.array(np.concatenate(parts))], names=["key", "answer"])

    return run


class Tree:
    """Per depth sorted keys, the weight of the own estimate, P(one): from depth ``root`` on the
    nodes of one group of contexts, above it those of all."""

    def __init__(self, depth: int, levels: dict, contexts: int, root: int) -> None:
        self.depth, self.levels, self.contexts, self.root = depth, levels, contexts, root

    def log10(self, gram: np.ndarray) -> np.ndarray:
        """log10 of the probability of each byte in its context."""
        symbol, context, total = gram & 0xFF, gram >> 8, np.zeros(len(gram))
        for level in range(8):
            bit = (symbol >> (7 - level)) & 1
            node = (1 << level) | (symbol >> (8 - level))
            p = np.full(len(gram), 0.5)
            for depth in range(self.depth, -1, -1):
                keys, weight, one = self.levels[depth]
                if not len(keys):
                    continue
                key = ((context & ((1 << (8 * depth)) - 1)) << 8) | node
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                mixed = weight[at] * one[at] + (1 - weight[at]) * p
                p = np.where(keys[at] == key, mixed, p)
            total += np.log10(np.where(bit == 1, p, 1 - p))
        return total


class _Known:
    """The answers for a chunk's strings, in a table by hash."""

    def __init__(self, gram: np.ndarray, answer: np.ndarray) -> None:
        order = np.argsort(gram)
        self.grams, self.answers = gram[order], answer[order]
        self.slots = np.zeros(1 << _SLOTS, np.int32)
        self.slots[self._slot(self.grams)] = np.arange(len(gram))

    @staticmethod
    def _slot(gram: np.ndarray) -> np.ndarray:
        return ((gram.astype(np.uint64) * W.BASE) >> np.uint64(64 - _SLOTS)).astype(np.int64)

    def lookup(self, gram: np.ndarray) -> np.ndarray:
        at = self.slots[self._slot(gram)]
        miss = np.flatnonzero(self.grams[at] != gram)
        if len(miss):  # another string's slot
            at[miss] = np.searchsorted(self.grams, gram[miss])
        return self.answers[at]


def _score(held, depth: int):
    """Scores a chunk's texts by the answers for its strings."""

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        hot, hot_counts = held.value
        known, parts = _Known(answers.column("key").to_numpy(), answers.column("answer").to_numpy()), []
        for batch in W.slices(iter(texts.to_batches()), "text"):
            found = W.scan(batch.column("text"), W.SPACED, True)
            data, begin = _texts(found, depth)
            n_bytes = np.diff(np.r_[begin, len(data) + depth]) - depth
            value = known.lookup(_grams(data, begin, depth))
            score = np.add.reduceat(value, np.cumsum(n_bytes) - n_bytes)
            keys, counts = _word_keys(found), found.counts()
            at = np.minimum(np.searchsorted(hot, keys), max(0, len(hot) - 1))
            is_hot = hot[at] == keys if len(hot) else np.zeros(len(keys), bool)
            logs = np.where(is_hot, np.log10(hot_counts[at] + 1.0), 0) if len(hot) else is_hot * 0.0
            text = found.text_of()
            sums = np.bincount(text, logs, len(counts)).astype(float)  # of no words: integers
            n_known = np.bincount(text, is_hot, len(counts)).astype(np.int64)
            cuts = np.searchsorted(text[~is_hot], np.arange(len(counts) + 1))
            rare = pa.LargeListArray.from_arrays(pa.array(cuts, pa.int64()), pa.array(keys[~is_hot]))
            columns = {
                "doc_id": batch.column("doc_id"),
                "held_out": batch.column("held_out"),
                "score": pa.array(score),
                "rid": batch.column("rid"),
                "n_tokens": pa.array(counts + 1),
                "n_bytes": pa.array(n_bytes),
                "hot_known": pa.array(n_known),
                "hot_logs": pa.array(sums),
                "rare": rare.cast(pa.list_(pa.int64())),
            }
            parts.append(pa.table(columns))
        return pa.concat_tables(parts)

    return run


_SCORED = (
    "doc_id {kind}, held_out boolean, score double, rid bigint, n_tokens bigint,"
    " n_bytes bigint, hot_known bigint, hot_logs double, rare array<bigint>"
)


def score_texts(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    depth: int = DEPTH,
    folds: int = FOLDS,
    held_fold: int = HELD_FOLD,
    block_nodes: int = BLOCK_NODES,
    hot_words: int = HOT_WORDS,
) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of the
    text's probability), n_bytes and bits_per_byte."""
    if not 2 <= depth <= 6:
        raise ValueError("depth is 2 to 6 bytes")
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "tree")
    fold = F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")) % folds
    docs = docs.select(
        F.col(id).alias("doc_id"), (fold == held_fold).alias("held_out"), F.col(text).alias("text")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.mapInArrow(
        _chunks, f"doc_id {kind}, held_out boolean, text string, rid bigint, chunk bigint"
    )
    docs = scratch.land(docs, "texts", "zstd")
    listed = docs.select("held_out", "text", "chunk").mapInArrow(
        _count(depth), "kind int, chunk bigint, key bigint, n bigint"
    )
    listed = scratch.land(listed, "listed", "zstd")
    counted = scratch.land(listed.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts", "zstd")
    words = counted.where(F.col("kind") == _WORD)
    grams = counted.where(F.col("kind") == _GRAM).select("key", "n")

    context = F.shiftrightunsigned("key", 8)
    pair, three = context.bitwiseAND(0xFFFF), context.bitwiseAND(0xFFFFFF)
    large = grams.groupBy(pair.alias("pair")).agg(F.count("*").alias("n"))
    large = large.where(F.col("n") * 8 * (depth - 1) > block_nodes) if depth > 2 else large.where("false")
    is_large = pair.isin([r["pair"] for r in large.collect()])
    grams = grams.select(
        "key",
        "n",
        F.when(is_large, 3).otherwise(2).alias("root"),
        F.when(is_large, three).otherwise(pair).alias("contexts"),
    )
    roots = grams.groupBy("root", "contexts").applyInArrow(_roots(depth), _ROOT)
    roots = scratch.land(roots, "roots")
    sums = [F.sum(c).alias(c) for c in ("n0", "n1", "weighted")]
    byte = context.bitwiseAND(0xFF) * 256 + F.col("key").bitwiseAND(0xFF)
    top = roots.where("depth = 2").groupBy(byte.alias("key")).agg(*sums)  # at most 256 * 255 rows
    two = roots.where("depth = 3").groupBy(F.col("key").bitwiseAND(0xFFFFFF).alias("key")).agg(*sums)
    top, two = (
        [frame.sort_values("key")[c].to_numpy() for c in ("key", "n0", "n1", "weighted")]
        for frame in (top.toPandas(), two.toPandas())  # of two: at most 255 rows a large group
    )
    levels = {d: (np.zeros(0, np.int64), np.zeros(0), np.zeros(0)) for d in range(depth + 1)}
    if len(two[0]):
        _, key, odds, one, n0, n1, both = next(_up(*two, 2, 2))
        levels[2] = (key, _weight(odds), one)
        key = key & 0xFFFF
        top = [np.concatenate(c) for c in zip(top, (key, n0, n1, both), strict=True)]
    if len(top[0]):
        for level, key, odds, one, *_ in _up(*_summed(*top), 1, 0):
            levels[level] = (key, _weight(odds), one)

    total = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens, kinds = int(total.n or 0), int(total.v)
    hot = words.where(F.col("key") != _END_WORD).orderBy(F.desc("n"), "key").limit(hot_words)
    hot = hot.select("key", "n").toArrow()
    hot_keys, hot_counts = hot.column("key").to_numpy(), hot.column("n").to_numpy()
    order = np.argsort(hot_keys)
    hot_keys, hot_counts = hot_keys[order], hot_counts[order]

    above = spark.sparkContext.broadcast(levels)
    answers = grams.groupBy("root", "contexts").applyInArrow(
        _answers(above, depth), "key bigint, answer double"
    )
    answers = scratch.land(answers, "answers")
    strings = listed.where(F.col("kind") == _GRAM).select("chunk", "key")
    strings = strings.join(answers, "key").groupBy("chunk")
    frame = docs.groupBy("chunk").cogroup(strings).applyInArrow(
        _score(spark.sparkContext.broadcast((hot_keys, hot_counts)), depth), _SCORED.format(kind=kind)
    )
    scored = scratch.land(frame, "scored")

    cold = words.where("false")
    if len(hot) == hot_words:  # what comes after the last of the broadcast ones
        least, key = hot.column("n")[-1].as_py(), hot.column("key")[-1].as_py()
        cold = words.where((F.col("n") < least) | ((F.col("n") == least) & (F.col("key") > key)))
        cold = cold.where(F.col("key") != _END_WORD)
    rare = scored.select("rid", F.explode("rare").alias("key")).join(cold, "key")
    rare = rare.groupBy("rid").agg(
        F.count("*").alias("rare_known"), F.sum(F.log10(F.col("n") + 1)).alias("rare_logs")
    )
    end_logs = float(np.log10(_end_count(words) + 1)) if tokens else 0.0
    each = float(np.log10(tokens + kinds + 1))
    return scored.join(rare, "rid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("hot_known") + F.coalesce("rare_known", F.lit(0)) + F.lit(int(tokens > 0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (
            F.col("hot_logs")
            + F.coalesce("rare_logs", F.lit(0.0))
            + F.lit(end_logs)
            - F.col("n_tokens") * F.lit(each)
        ).alias("base_score"),
        "score",
        "n_bytes",
        (-F.col("score") / F.col("n_bytes") * F.lit(float(np.log2(10)))).alias("bits_per_byte"),
    )


def _weight(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def _end_count(words: DataFrame) -> int:
    row = words.where(F.col("key") == _END_WORD).first()
    return int(row.n) if row else 0
