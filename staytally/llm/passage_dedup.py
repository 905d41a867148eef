"""Operator 9: words inside passages that stand earlier in the corpus go.

A window is ``WINDOW`` consecutive words. Its minimiser is the least of its word triples in a
fixed random order, with triples that are frequent in a sample of documents ranked last:
the sample only balances buckets, no result depends on it. Consecutive windows with the same
minimiser travel as one packed string (a super-k-mer, compressed) to the minimiser's bucket.
There they come sorted by document and place, and a set of the windows' own bytes tells which
have been met: memory is bounded by one minimiser's distinct windows, however often they
occur. A string alone in its bucket holds nothing twice.
Before the shuffle a task settles windows that repeat among its own documents, so a passage
of a third of all documents sends a copy a task and not a copy a document.

A window counts as earlier by (doc_id, row, start), where row is the number that an input row is
landed with: rows of one id, and rows without an id, are texts of their own, and which of them is
the earlier follows the input's order. A null id precedes all others. A null or empty text has no
words. Texts under ``WINDOW`` words stay
whole. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from staytally.llm import words as W
from staytally.llm.scratch import Scratch

WINDOW = 20
GRAM = 3
#: Documents looked at for frequent word triples, and the share that makes one frequent.
ORDER_SAMPLE = 4000
FREQUENT_SHARE = 0.002
_FREQUENT_MOST = 20_000
#: Texts that the compression dictionary is fitted to, none over so many bytes.
DICTIONARY_SAMPLE, _DICTIONARY_TEXT = 1000, 1 << 14
_NO_ID = -(2**63)

_TRAVEL = "mini bigint, doc_id bigint, rid bigint, start int, windows int, packed binary"
_SPAN = "rid bigint, start int, stop int"


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _squeezed(found: W.Words) -> W.Words:
    """The same words with one space after each."""
    word = W.SPACED[found.data]
    kept = word.copy()
    kept[1:] |= word[:-1]
    moved = np.cumsum(kept) - kept
    data = np.where(word, found.data, np.uint8(0x20))[kept]
    return W.Words(data, moved[found.starts], moved[found.ends - 1] + 1, found.first)


def _runs(index: np.ndarray, *same: np.ndarray) -> np.ndarray:
    """Where a run of consecutive indices with equal values begins; and the end of the last."""
    if not len(index):
        return np.zeros(1, np.int64)
    new = np.diff(index) != 1
    for values in same:
        new |= values[1:] != values[:-1]
    return np.r_[0, np.flatnonzero(new) + 1, len(index)]


def _met_here(found: W.Words, hashes, window, at, doc, rid, start, width) -> np.ndarray:
    """Windows with an earlier equal among the slice's own."""
    order = np.lexsort((start, rid, doc, window))
    key = window[order]
    head = np.r_[True, key[1:] != key[:-1]]
    first = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    later = ~head
    mine, other = order[later], first[later]
    step = np.arange(width)
    n = len(found)
    code = np.unique((at[mine] * n + at[other])[:, None] + step * (n + 1))
    equal = found.same(code // n, code % n)
    met = np.zeros(len(window), bool)
    met[mine] = True
    if not equal.all():  # words that share a hash but not their bytes: leave these to the buckets
        odd = (at[mine] * n + at[other])[:, None] + step * (n + 1)
        met[mine] = ~np.isin(odd, code[~equal]).any(1)
    return met


def _order(hashes: np.ndarray) -> np.ndarray:
    """The random order's value of each run of ``GRAM`` words (across texts too)."""
    total, n = np.zeros(max(0, len(hashes) - GRAM + 1), np.uint64), len(hashes)
    for j in range(GRAM if len(total) else 0):
        total = total * W.BASE + hashes[j : n - GRAM + 1 + j]
    return W.mix(total) >> np.uint64(2)


def _dictionary(data: bytes):
    return zstandard.ZstdCompressionDict(data) if data else None


def _travellers(fitted, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, dictionary = fitted.value
        pack = zstandard.ZstdCompressor(
            dict_data=_dictionary(dictionary), write_checksum=False, write_dict_id=False
        ).compress
        for batch in W.slices(batches, "text"):
            found = _squeezed(W.scan(batch.column("text"), W.SPACED, False))
            hashes = found.hashes()
            window, at = W.rolled(hashes, found.first, width)
            if not len(window):
                continue
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            text = found.text_of()[at]
            doc, rid, start = ids[text], batch.column("rid").to_numpy()[text], at - found.first[text]
            order = _order(hashes)
            if len(last):
                near = np.minimum(np.searchsorted(last, order), len(last) - 1)
                order = np.where(last[near] == order, order | np.uint64(1 << 62), order)
            mini = _sliding_min(order.astype(np.int64), width - GRAM + 1)[at]
            met = _met_here(found, hashes, window, at, doc, rid, start, width)

            own = np.flatnonzero(met)
            cuts = _runs(at[own], text[own])
            i, j = own[cuts[:-1]], own[cuts[1:] - 1]
            yield _rows(W.mix(rid[i].astype(np.uint64)).astype(np.int64), doc[i], rid[i], start[i],
                        j - i + 1, [None] * len(i))
            own = np.flatnonzero(~met)
            cuts = _runs(at[own], text[own], mini[own])
            i, j = own[cuts[:-1]], own[cuts[1:] - 1]
            low, high = found.starts[at[i]], found.ends[at[j] + width - 1]
            raw = found.data.tobytes()
            packed = [pack(raw[a:b]) for a, b in zip(low.tolist(), high.tolist(), strict=True)]
            yield _rows(mini[i], doc[i], rid[i], start[i], j - i + 1, packed)

    return run


def _rows(mini, doc, rid, start, windows, packed) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(mini, pa.int64()),
            pa.array(doc, pa.int64()),
            pa.array(rid, pa.int64()),
            pa.array(start.astype(np.int32)),
            pa.array(windows.astype(np.int32)),
            pa.array(packed, pa.binary()),
        ],
        names=["mini", "doc_id", "rid", "start", "windows", "packed"],
    )


def _bucket(fitted, width: int):
    """Rows come sorted by (mini, doc_id, rid, start); a row without a string is settled already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(fitted.value[1])).decompress
        current, seen = None, {}
        for batch in W.slices(batches, "packed"):
            mini = batch.column("mini").to_numpy()
            docs, places = batch.column("rid").to_pylist(), batch.column("start").to_pylist()
            windows, packed = batch.column("windows").to_pylist(), batch.column("packed")
            spans = [
                (docs[k], places[k], places[k] + windows[k] + width - 1)
                for k in np.flatnonzero(packed.is_null()).tolist()
            ]
            shared = np.zeros(len(mini), bool)  # the last may go on in the next batch
            shared[0], shared[-1] = mini[0] == current, True
            shared[1:] |= mini[1:] == mini[:-1]
            shared[:-1] |= mini[1:] == mini[:-1]
            rows = np.flatnonzero(shared & packed.is_valid().to_numpy(False))
            texts = pa.array([unpack(p) for p in packed.take(rows).to_pylist()], pa.binary())
            found = W.scan(texts, W.SPACED, False)
            raw = found.data.tobytes()
            starts, ends = found.starts.tolist(), found.ends[width - 1 :].tolist()
            minis = mini[rows].tolist()
            for k, key, first in zip(rows.tolist(), minis, found.first.tolist(), strict=False):
                if key != current:
                    current, seen = key, {}
                doc, place, stop = docs[k], places[k], None
                for j in range(windows[k]):
                    here = (doc, place + j)
                    window = raw[starts[first + j] : ends[first + j]]
                    if seen.setdefault(window, here) == here:
                        continue
                    if stop == place + j + width - 1:
                        spans[-1] = (doc, spans[-1][1], stop + 1)
                    else:
                        spans.append((doc, place + j, place + j + width))
                    stop = place + j + width
            if spans:
                columns = zip(*spans, strict=True)
                kinds = (pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                    names=["rid", "start", "stop"],
                )

    return run


def _fitted(docs: DataFrame) -> tuple[np.ndarray, bytes]:
    """From a sample: order values of frequent triples (some thousands at most), and a
    dictionary by which short strings compress. Neither changes a result."""
    total = docs.count()
    if not total:
        return np.zeros(0, np.uint64), b""
    share = min(1.0, ORDER_SAMPLE / total)
    some = docs.where(F.pmod(F.xxhash64("rid"), F.lit(1_000_000)) < int(share * 1_000_000) + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text"):
            found = W.scan(batch.column("text"), W.SPACED, False)
            hashes = found.hashes()
            if len(hashes) < GRAM:
                continue
            order, of = _order(hashes), found.text_of()[: 1 - GRAM]
            sort = np.lexsort((of, order))
            order, of = order[sort], of[sort]
            first = np.r_[True, (order[1:] != order[:-1]) | (of[1:] != of[:-1])]
            gram, n = np.unique(order[first], return_counts=True)  # documents that hold each
            kept = n > 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram[kept].astype(np.int64)), pa.array(n[kept])], names=["gram", "n"]
            )

    rows = (
        some.mapInArrow(count, "gram bigint, n bigint")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= max(2, int(FREQUENT_SHARE * share * total)))
        .orderBy(F.desc("n"), "gram")
        .limit(_FREQUENT_MOST)
        .collect()
    )
    texts = some.where(F.octet_length("text") < _DICTIONARY_TEXT).select("text")
    texts = [r.text.encode() for r in texts.limit(DICTIONARY_SAMPLE).collect()]
    dictionary = b""
    if len(texts) >= DICTIONARY_SAMPLE // 4:
        dictionary = zstandard.train_dictionary(1 << 16, texts).as_bytes()
    return np.sort(np.array([r.gram for r in rows], np.uint64)), dictionary


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.slices(batches, "text"):
        found = _squeezed(W.scan(batch.column("text"), W.SPACED, False))
        raw, first = found.data.tobytes(), found.first.tolist()
        removed, texts = [], []
        for d, spans in enumerate(batch.column("spans").to_pylist()):
            n, parts, at = first[d + 1] - first[d], [], 0
            gone = 0
            for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
                start = max(start, at)
                if stop > start:
                    if start > at:
                        parts.append((at, start))
                    gone, at = gone + stop - start, stop
            if at < n:
                parts.append((at, n))
            texts.append(
                b" ".join(
                    raw[found.starts[first[d] + i] : found.ends[first[d] + j - 1]] for i, j in parts
                ).decode()
            )
            removed.append(gone)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(found.counts(), pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(texts, pa.string()),
            ],
            names=["doc_id", "n_words", "n_removed", "text"],
        )


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(rid, start, stop) of words covered by windows that stand earlier; spans may overlap. Takes
    rows of (doc_id, rid, text), rid being unique."""
    fitted = docs.sparkSession.sparkContext.broadcast(_fitted(docs))
    return (
        docs.mapInArrow(_travellers(fitted, window), _TRAVEL)
        .repartition("mini")
        .sortWithinPartitions("mini", "doc_id", "rid", "start")
        .mapInArrow(_bucket(fitted, window), _SPAN)
    )


def drop_repeated_passages(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """Per row: doc_id, n_words, n_removed and the text of the kept words, one space between."""
    if window <= GRAM:
        raise ValueError(f"a window needs more than {GRAM} words")
    scratch = Scratch(docs.sparkSession, "passages")
    docs = docs.select(
        F.coalesce(F.col(id).cast("long"), F.lit(_NO_ID)).alias("doc_id"),
        F.monotonically_increasing_id().alias("rid"),
        F.col(text).alias("text"),
    )
    docs = scratch.land(docs, "texts", "zstd")
    spans = (
        scratch.land(repeated_spans(docs, window), "spans")
        .groupBy("rid")
        .agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    )
    out = docs.join(spans, "rid", "left").mapInArrow(
        _kept, "doc_id bigint, n_words bigint, n_removed bigint, text string"
    )
    return out.withColumn("doc_id", F.nullif(F.col("doc_id"), F.lit(_NO_ID)))
