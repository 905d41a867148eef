"""Operator 13: texts rearranged for infilling, cut between tokens found in 64-bit words.

A slice of UTF-8 texts is viewed as uint64 words. White space is marked in the top bit of each byte
by additions that never carry into the next byte; a byte ends a unit if it is not white space and
the next one is, or if it is the last of its text. ``bitwise_count`` per word and a running sum
then give the number of units up to any byte, and the k-th unit's end: the running sum is searched
for the word, and inside the word the lowest marks are cleared until the wanted one is lowest.
The first bytes of code points are marked and counted in the same way. The arithmetic runs in
blocks, so a long text costs a few times its own size and no more.

A unit is ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+`` or the white space that ends a text. The draws
are taken from a hash of the seed and the id: rows of one id and rerun jobs are cut alike, and
rows without an id draw from the seed alone. Null texts count as empty, and empty texts and those
that hold a mark stay plain. Each input row comes back; empty tables give empty results. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from staytally.llm import words as W

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Hundredths of the texts that are rearranged, and of those that begin with the suffix.
RATE, SPM_RATE, SEED = 50, 80, 42

_SLICE = 1 << 20
_BLOCK = 1 << 16  # words
_EACH = np.uint64(0x0101010101010101)
_TOP = np.uint64(0x8080808080808080)
_ONE, _SEVEN, _EIGHT, _LAST = np.uint64(1), np.uint64(7), np.uint64(8), np.uint64(56)


def _below(limit: int) -> np.uint64:
    """What carries a byte of at least ``limit`` into its top bit."""
    return _EACH * np.uint64(0x80 - limit)


def _space(word: np.ndarray) -> np.ndarray:
    """Top bits of the bytes 0x20 and 0x09 to 0x0D."""
    low = word & ~_TOP
    tab_to_return = (low + _below(0x09)) & ~(low + _below(0x0E))
    blank = ~((low ^ (_EACH * np.uint64(0x20))) + _below(0x01))
    return (tab_to_return | blank) & ~word & _TOP


def _begins(word: np.ndarray) -> np.ndarray:
    """Top bits of the bytes that begin a code point: all but 10xxxxxx."""
    return (~word | (word << _ONE)) & _TOP


class Marks:
    """Marked bytes, counted up to a byte (``rank``) and found by number (``select``)."""

    def __init__(self, marks: np.ndarray) -> None:
        self.marks = marks
        self.before = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks in the bytes before ``at``."""
        word = at >> 3
        part = (_ONE << (_EIGHT * (at.astype(np.uint64) & _SEVEN))) - _ONE
        return self.before[word] + np.bitwise_count(self.marks[word] & part)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte of the ``k``-th mark, counted from 1."""
        word = np.searchsorted(self.before, k) - 1
        left, bits = k - self.before[word], self.marks[word]
        for skipped in range(1, 8):
            bits = np.where(left > skipped, bits & (bits - _ONE), bits)
        lowest = bits & (~bits + _ONE)
        return word * 8 + (np.bitwise_count(lowest - _ONE) >> 3)


def _scan(data: np.ndarray, offsets: np.ndarray) -> tuple[Marks, Marks]:
    """Ends of units, and first bytes of code points, in the bytes of texts one after another."""
    n = len(data) // 8 + 2  # at least one byte of white space follows the last text
    ends, begins = np.empty(n, np.uint64), np.empty(n, np.uint64)
    padded = np.full(8 * (_BLOCK + 1), 0x20, np.uint8)
    for at in range(0, n, _BLOCK):
        size = min(_BLOCK, n - at)
        piece = data[8 * at : 8 * (at + size + 1)]
        padded[: len(piece)] = piece
        padded[len(piece) :] = 0x20
        word = padded.view("<u8")[: size + 1]
        space = _space(word)
        following = (space[:-1] >> _EIGHT) | (space[1:] << _LAST)
        ends[at : at + size] = ~space[:-1] & following & _TOP
        begins[at : at + size] = _begins(word[:-1])
    last = offsets[1:][np.diff(offsets) > 0] - 1
    bit = np.uint64(0x80) << (_EIGHT * (last.astype(np.uint64) & _SEVEN))
    np.bitwise_or.at(ends, last >> 3, bit)
    return Marks(ends), Marks(begins)


def cut(texts: pa.Array, first: np.ndarray, second: np.ndarray):
    """Units of each text, its bytes, and the byte and code point at which two draws cut it.

    Returns ``n, data, offsets, cuts, points``; both ``cuts`` and ``points`` have a row for the
    smaller and one for the larger number of units.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    low, high = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(data, np.uint8)[low:high] if high > low else np.zeros(0, np.uint8)
    offsets = offsets - low
    ends, begins = _scan(data, offsets)
    earlier = ends.rank(offsets)
    n = np.diff(earlier)
    units = np.sort(np.stack([first % (n + 1), second % (n + 1)]), axis=0)
    cuts = np.where(units > 0, 0, offsets[:-1])
    inside = units > 0
    wanted = earlier[:-1] + units
    cuts[inside] = ends.select(wanted[inside]) + 1
    points = begins.rank(cuts.ravel()).reshape(cuts.shape) - begins.rank(offsets[:-1])
    return n, data, offsets, cuts, points


def _arrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    for batch in W.slices(batches, "text", _SLICE):
        draws = [batch.column(name).to_numpy(zero_copy_only=False) for name in ("first", "second")]
        n, data, offsets, cuts, points = cut(batch.column("text"), *draws)
        forms, raw = batch.column("form").to_pylist(), memoryview(data)
        out = []
        spans = zip(forms, offsets[:-1].tolist(), *cuts.tolist(), offsets[1:].tolist(), strict=True)
        for form, start, a, b, stop in spans:
            prefix, middle, suffix = raw[start:a], raw[a:b], raw[b:stop]
            if form == PLAIN:
                out.append(bytes(raw[start:stop]))
            elif form == PSM:
                out.append(b"".join((marks[0], prefix, marks[1], suffix, marks[2], middle)))
            else:
                out.append(b"".join((marks[1], suffix, marks[0], prefix, marks[2], middle)))
        cutting = np.array([form == PLAIN for form in forms], bool)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n),
                batch.column("form"),
                pa.array(points[0], mask=cutting),
                pa.array(points[1] - points[0], mask=cutting),
                pa.array(out, pa.binary()).cast(pa.string()),
            ],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )


def fill_in_middle(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
) -> DataFrame:
    """Per row: doc_id, n units, form, prefix_chars, middle_chars and the output text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))), 256)
    draws = [
        F.conv(F.substring("digest", 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)
    ]
    body = F.coalesce(F.col("text"), F.lit(""))
    marked = F.contains(body, F.lit(PREFIX)) | F.contains(body, F.lit(SUFFIX))
    marked = marked | F.contains(body, F.lit(MIDDLE))
    form = (
        F.when((body == "") | marked | (draws[2] % 100 >= rate), PLAIN)
        .when(draws[3] % 100 < spm_rate, SPM)
        .otherwise(PSM)
    )
    drawn = (
        docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"), digest.alias("digest"))
        .select("doc_id", "text", form.alias("form"), draws[0].alias("first"), draws[1].alias("second"))
    )
    schema = StructType.fromDDL(
        "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    )
    kind = StructField("doc_id", drawn.schema["doc_id"].dataType)
    return drawn.mapInArrow(_arrange, StructType([kind, *schema.fields]))


def restored(output: Column | str, form: Column | str) -> Column:
    """The text of an output: marks cannot occur in it, so the first of each kind divides."""
    output = F.col(output) if isinstance(output, str) else output
    form = F.col(form) if isinstance(form, str) else form
    size = len(PREFIX)

    def parts(second: str) -> tuple[Column, Column, Column]:
        """What follows the opening mark, the second one, and the middle's."""
        at, last = F.locate(second, output), F.locate(MIDDLE, output)
        return (
            F.substr(output, F.lit(size + 1), at - size - 1),
            F.substr(output, at + size, last - at - size),
            F.substr(output, last + size),
        )

    prefix, suffix, middle = parts(SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(PREFIX)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == PLAIN, output).when(form == PSM, psm).otherwise(spm)
