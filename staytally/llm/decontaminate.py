"""Operator 1: words of documents that repeat passages of benchmark items.

Each task packs its documents into shards, builds an FM-index over a shard's words and
searches all phrases backward in it. Words that no phrase holds cannot be part of a match:
they and the ends of texts become separators, a run of them one.

Phrases come to the driver in blocks of at most ``BLOCK_WORDS`` words, and the documents
pass through one step a block, so a larger benchmark costs time and not memory.

Nulls: a null text has no words, a null item no phrases. Items without an id are searched like
others and are one item without a name.
Empty tables, repeated rows and repeated ids are no special case: every row is judged alone.
Other columns are passed over (or, by ``remove_passages``, kept).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from staytally.llm import words as W
from staytally.llm.fm_index import FMIndex
from staytally.llm.scratch import Scratch

WINDOW = 10
BLOCK_WORDS = 4_000_000
SHARD_WORDS = 1 << 20


class Phrases:
    """Windows of benchmark items, as codes of their words."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        self.items = [item for item, _ in items]
        found = W.scan(pa.array([text for _, text in items], pa.string()), W.ALNUM, True)
        self.hash, code = np.unique(found.hashes(), return_inverse=True)
        code = code.astype(np.int64) + 1
        self.word = {int(c): found.word(i) for i, c in enumerate(code)}
        by_length: dict[int, dict[tuple, set[int]]] = {}
        for item, (i, j) in enumerate(zip(found.first, found.first[1:], strict=False)):
            width = min(window, j - i)
            if width:
                own = by_length.setdefault(int(width), {})
                for at in range(i, j - width + 1):
                    own.setdefault(tuple(code[at : at + width].tolist()), set()).add(item)
        self.groups = [
            (np.array(list(own), np.int64), [sorted(x) for x in own.values()])
            for _, own in sorted(by_length.items())
        ]
        self.longest = max(by_length, default=0)

    def codes(self, found: W.Words) -> np.ndarray:
        hashes = found.hashes()
        if not len(self.hash):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        return np.where(self.hash[at] == hashes, at + 1, 0)

    def matches(self, found: W.Words, shard_words: int = SHARD_WORDS):
        """Arrays of (first word, number of words, item) of every occurrence."""
        codes, text = self.codes(found), found.text_of()
        out = [np.zeros((0, 3), np.int64)]
        for low in range(0, len(codes), shard_words):
            high = min(len(codes), low + shard_words + self.longest - 1)
            place = np.arange(low, high) + text[low:high] - text[low]  # room for text ends
            seq = np.zeros(place[-1] - low + 2, np.int64)
            seq[place - low] = codes[low:high]
            kept = (seq != 0) | np.r_[True, seq[:-1] != 0]
            kept[-1] = True
            origin = np.zeros(len(seq), np.int64)
            origin[place - low] = np.arange(low, high)
            index, origin = FMIndex(seq[kept], len(self.hash)), origin[kept]
            for phrases, items in self.groups:
                first, last = index.search(phrases)
                which = np.repeat(np.arange(len(phrases)), last - first)
                if not len(which):
                    continue
                skip = np.repeat(np.cumsum(last - first) - (last - first), last - first)
                rows = np.repeat(first, last - first) + np.arange(len(which)) - skip
                start = origin[index.locate(rows)]
                good = self._same(found, phrases, which, start)
                which, start = which[good], start[good]
                n = np.array([len(items[k]) for k in which], np.int64)
                each = np.array([i for k in which for i in items[k]], np.int64)
                width = np.full(len(each), phrases.shape[1])
                out.append(np.stack([np.repeat(start, n), width, each], 1))
        return np.concatenate(out)

    def _same(self, found, phrases, which, start) -> np.ndarray:
        """Words had met by hash; now by their bytes."""
        seen: dict[tuple[int, int], bool] = {}

        def same(at: int, code: int) -> bool:
            if (known := seen.get((at, code))) is None:
                known = seen[at, code] = found.word(at) == self.word[code]
            return known

        return np.array(
            [
                all(same(s + j, c) for j, c in enumerate(phrases[k].tolist()))
                for k, s in zip(which.tolist(), start.tolist(), strict=True)
            ],
            bool,
        )


def merged(first: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Spans [start, end) of the words in any occurrence, apart from each other."""
    order = np.argsort(first, kind="stable")
    first, end = first[order], (first + width)[order]
    if not len(first):
        return np.zeros((0, 2), np.int64)
    reach = np.maximum.accumulate(end)
    head = np.r_[True, first[1:] > reach[:-1]]
    return np.stack([first[head], reach[np.r_[np.flatnonzero(head)[1:] - 1, len(first) - 1]]], 1)


def _blocks(benchmark: DataFrame, item: str, text: str, window: int, block: int):
    """Phrases of the benchmark, some words' worth at a time."""
    rows = benchmark.where(F.col(text).isNotNull())
    rows = rows.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t"))
    held, size = [], 0
    for row in rows.toLocalIterator():
        held.append((row.i, row.t))
        size += len(row.t) // 2
        if size >= block:
            yield Phrases(held, window)
            held, size = [], 0
    if held:
        yield Phrases(held, window)


def _pass(phrases, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = phrases.value
        for batch in W.slices(batches, text):
            found = W.scan(batch.column(text), W.ALNUM, True)
            hits = known.matches(found)
            of = np.searchsorted(found.first, hits[:, 0], "right") - 1
            spans = batch.column("_spans").to_pylist()
            items = batch.column("_items").to_pylist()
            order = np.argsort(of, kind="stable")
            of, hits = of[order], hits[order]
            cuts = np.r_[0, np.flatnonzero(np.diff(of)) + 1, len(of)] if len(of) else [0]
            for i, j in zip(cuts, cuts[1:], strict=False):
                d, own = int(of[i]), hits[i:j]
                new = merged(own[:, 0] - found.first[d], own[:, 1])
                if spans[d]:
                    old = np.array([[s["start"], s["end"]] for s in spans[d]], np.int64)
                    both = np.concatenate([old, new])
                    new = merged(both[:, 0], both[:, 1] - both[:, 0])
                spans[d] = [{"start": int(a), "end": int(b)} for a, b in new]
                names = {known.items[k] for k in np.unique(own[:, 2])}
                items[d] = sorted(names.union(items[d]), key=lambda name: (name is None, name or ""))
            columns = [
                batch.column(f.name) if not f.name.startswith("_") else None for f in batch.schema
            ]
            columns[-3:] = [
                pa.array(found.counts(), pa.int64()),
                pa.array(spans, batch.schema.field("_spans").type),
                pa.array(items, batch.schema.field("_items").type),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return run


def _searched(docs, benchmark, text, item, item_text, window, block_words) -> DataFrame:
    frame = docs.withColumns(
        {
            "_words": F.lit(0).cast("long"),
            "_spans": F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)"),
            "_items": F.expr("cast(array() as array<string>)"),
        }
    )
    schema = StructType([StructField(f.name, f.dataType) for f in frame.schema])
    spark, scratch, landed = docs.sparkSession, None, None
    blocks = _blocks(benchmark, item, item_text, window, block_words)
    phrases = next(blocks, None) or Phrases([], window)
    while True:
        held = spark.sparkContext.broadcast(phrases)
        frame = frame.mapInArrow(_pass(held, text), schema)
        phrases = next(blocks, None)
        if phrases is None:
            return frame
        scratch = scratch or Scratch(spark, "decontaminate")
        stands = scratch.land(frame, "searched", "zstd")
        held.destroy()
        if landed is not None:
            scratch.drop(landed)
        frame = landed = stands


def _private(docs: DataFrame) -> None:
    if clash := {"_words", "_spans", "_items"} & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} are reserved here")


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row a document: its words, the spans of words to remove, and the items found in it."""
    frame = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    frame = _searched(frame, benchmark, "text", item, item_text, window, block_words)
    return frame.select(
        "doc_id",
        F.col("_words").alias("n_words"),
        F.expr("aggregate(_spans, 0L, (n, s) -> n + s.end - s.start)").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.col("_items").alias("item_ids"),
        F.col("_spans").alias("spans"),
    )


def remove_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents without the found passages; those of which no word is left go.

    A span goes from the first letter of its first word to the last of its last; what stood
    around it is joined by one space. Clean documents pass unchanged.
    """
    _private(docs)
    frame = _searched(docs, benchmark, text, item, item_text, window, block_words)
    schema = frame.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = schema.fieldNames().index(text)
        for batch in W.slices(batches, text):
            spans = batch.column("_spans").to_pylist()
            if any(spans):
                found = W.scan(batch.column(text), W.ALNUM, True)
                texts = batch.column(text).to_pylist()
                for d, own in enumerate(spans):
                    if own:
                        texts[d] = without(texts[d], found, d, own)
                field = batch.schema.field(at)
                batch = batch.set_column(at, field, pa.array(texts, field.type))
            yield batch

    frame = frame.mapInArrow(cut, schema)
    kept = F.expr("_words = 0 or aggregate(_spans, 0L, (n, s) -> n + s.end - s.start) < _words")
    return frame.where(kept).drop("_words", "_spans", "_items")


def without(text: str, found: W.Words, d: int, spans: list[dict]) -> str:
    raw, first = text.encode(), found.first[d]
    low = int(found.starts[first]) - _lead(raw)
    parts, at = [], 0
    for span in spans:
        start = int(found.starts[first + span["start"]]) - low
        parts.append(raw[at:start].rstrip())
        at = int(found.ends[first + span["end"] - 1]) - low
    parts.append(raw[at:].lstrip())
    return b" ".join(p for p in parts if p).decode()


def _lead(raw: bytes) -> int:
    """Bytes before the first word."""
    lowered = W._LOWER[np.frombuffer(raw, np.uint8)]
    return int(np.argmax(W.ALNUM[lowered]))
