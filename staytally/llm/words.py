"""Words of many texts at once: boundaries and hashes by numpy over Arrow's own bytes.

The word classes are decided per byte. Bytes from 0x80 on belong to characters outside
ASCII and are word bytes in both classes, so UTF-8 needs no decoding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 8 << 20
_HASH_BYTES = 1 << 18


def _table(inside) -> np.ndarray:
    return np.array([bool(inside(b)) for b in range(256)])


#: ``[^\x20\x09-\x0D]+``
SPACED = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``
ALNUM = _table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)

# One 64-bit value per byte and an odd base; both only need to be arbitrary and fixed.
_SEED = np.random.default_rng(20_240_607)
_VALUES = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(BASE, _HASH_BYTES + 1), _powers(_INVERSE, _HASH_BYTES + 1)


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts of the slice, one after another
    starts: np.ndarray  # of each word in data
    ends: np.ndarray
    first: np.ndarray  # index of each text's first word, and the number of words

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text's index for each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether word a[i] has the bytes of word b[i]."""
        size = self.ends[a] - self.starts[a]
        out = size == self.ends[b] - self.starts[b]
        for at in range(0, len(a), 1 << 16):
            left = at + np.flatnonzero(out[at : at + (1 << 16)])
            sizes = size[left]
            skip = np.repeat(np.cumsum(sizes) - sizes, sizes)
            offset = np.arange(int(sizes.sum())) - skip
            x = self.data[np.repeat(self.starts[a[left]], sizes) + offset]
            y = self.data[np.repeat(self.starts[b[left]], sizes) + offset]
            out[np.repeat(left, sizes)[x != y]] = False
        return out

    def hashes(self) -> np.ndarray:
        """64 bits for each word, equal for equal words on every machine."""
        out = np.empty(len(self), np.uint64)
        i = 0
        while i < len(self):
            j = int(np.searchsorted(self.ends, self.starts[i] + _HASH_BYTES, "right"))
            if j <= i:
                out[i], j = _long_hash(self.data[self.starts[i] : self.ends[i]]), i + 1
            else:
                out[i:j] = _short_hashes(self.data, self.starts[i:j], self.ends[i:j])
            i = j
        return mix(out)


def _short_hashes(data, starts, ends) -> np.ndarray:
    low = starts[0]
    sums = np.zeros(ends[-1] - low + 1, np.uint64)
    np.cumsum(_VALUES[data[low : ends[-1]]] * _UP[: len(sums) - 1], out=sums[1:])
    return (sums[ends - low] - sums[starts - low]) * _DOWN[starts - low]


def _long_hash(word) -> np.uint64:
    total, scale = np.uint64(0), np.uint64(1)
    with np.errstate(over="ignore"):
        for at in range(0, len(word), _HASH_BYTES):
            piece = _VALUES[word[at : at + _HASH_BYTES]]
            total += scale * np.sum(piece * _UP[: len(piece)], dtype=np.uint64)
            scale *= _UP[_HASH_BYTES]
    return total


def scan(texts: pa.Array, inside: np.ndarray, lower: bool) -> Words:
    """Words of every text; null has none."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    low, high = (int(offsets[0]), int(offsets[-1])) if len(texts) else (0, 0)
    data = np.frombuffer(data, np.uint8)[low:high] if high > low else np.zeros(0, np.uint8)
    offsets = offsets - low if len(texts) else np.zeros(1, np.int64)
    if lower:
        data = _LOWER[data]
    word = inside[data]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    before[cuts] = False
    after[cuts - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of some ``limit`` bytes of text, a longer text alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(False)
        group = np.cumsum(sizes, dtype=np.int64) // limit
        at = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for i, j in zip(at, at[1:], strict=False):
            yield batch.slice(i, j - i)


def rolled(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` words inside one text, and the index of its first word."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n - width + 1, np.uint64)
    for j in range(width):
        total = total * BASE + hashes[j : n - width + 1 + j]
    last = np.repeat(first[1:], np.diff(first))[: len(total)]  # end of the text of each word
    inside = np.arange(len(total)) + width <= last
    return mix(total[inside]), np.flatnonzero(inside)
