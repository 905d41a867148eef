"""An FM-index over a sequence of integer symbols, for many phrases at a time.

Symbol 0 separates: it belongs to no phrase, and each of its places counts as a letter of
its own, ordered by place. The last symbol of a sequence must be 0.
"""

from __future__ import annotations

import numpy as np

SAMPLE_RATE = 16


def suffix_array(seq: np.ndarray, bits: int) -> np.ndarray:
    """Places of all suffixes in their order, by prefix doubling over what is still tied."""
    n, width = len(seq), max(1, 62 // bits)
    key, whole = np.zeros(n, np.int64), np.ones(n, bool)
    for j in range(width):
        ahead = np.zeros(n, np.int64)
        ahead[: max(0, n - j)] = seq[j:]
        key = (key << bits) | np.where(whole, ahead, 0)
        whole &= ahead != 0
    order = np.argsort(key)
    key = key[order]
    index = np.arange(n)
    head = np.r_[True, key[1:] != key[:-1]]
    group = np.maximum.accumulate(np.where(head, index, 0))
    rank = np.empty(n, np.int64)
    rank[order] = group
    tied = np.flatnonzero(~(head & np.r_[head[1:], True]))
    # Equal up to a separator: they differ by place alone, and must before others lean on them.
    ended = ~whole[order[tied]]
    at = tied[ended]
    place = order[at][np.argsort(group[at] * n + order[at])]
    order[at], rank[place] = place, at
    tied, step = tied[~ended], width
    while len(tied):
        place = order[tied]
        key = group[tied] * n + rank[place + step]
        by = np.argsort(key)
        place, key = place[by], key[by]
        head = np.r_[True, key[1:] != key[:-1]]
        start = tied[np.maximum.accumulate(np.where(head, np.arange(len(tied)), 0))]
        order[tied], rank[place], group[tied] = place, start, start
        tied = tied[~(head & np.r_[head[1:], True])]
        step *= 2
    return order


class WaveletTree:
    """Ranks of any symbol, one bit of the symbols a level (kept as a wavelet matrix)."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.bits, self.zeros = bits, []
        for level in reversed(range(bits)):
            one = (symbols >> level) & 1 == 1
            zeros = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(~one, out=zeros[1:])
            self.zeros.append(zeros)
            symbols = np.concatenate([symbols[~one], symbols[one]])

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        base, at = np.zeros(len(symbol), np.int64), upto.astype(np.int64)
        for zeros, level in zip(self.zeros, reversed(range(self.bits)), strict=True):
            one, all_zeros = (symbol >> level) & 1 == 1, zeros[-1]
            base = np.where(one, all_zeros + base - zeros[base], zeros[base])
            at = np.where(one, all_zeros + at - zeros[at], zeros[at])
        return at - base


class FMIndex:
    def __init__(self, seq: np.ndarray, n_symbols: int) -> None:
        bits = max(1, int(n_symbols).bit_length())
        order = suffix_array(seq, bits)
        self.n = len(seq)
        self.bwt = seq[order - 1]  # the sequence is a ring for the first suffix
        self.tree = WaveletTree(self.bwt, bits)
        self.before = np.zeros(n_symbols + 2, np.int64)
        np.cumsum(np.bincount(seq, minlength=n_symbols + 1), out=self.before[1:])
        # A suffix is sampled every few places, and where going back would meet a separator.
        self.marked = (order % SAMPLE_RATE == 0) | (self.bwt == 0)
        self.nth = np.cumsum(self.marked, dtype=np.int32) - 1
        self.samples = order[self.marked].astype(np.int32)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of all phrases (rows of one length): first and last + 1 suffix."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.n, np.int64)
        for symbol in phrases.T[::-1]:
            low = self.before[symbol] + self.tree.rank(symbol, low)
            high = self.before[symbol] + self.tree.rank(symbol, high)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of suffixes, by steps back to the next sampled one."""
        out, steps = np.empty(len(rows), np.int64), 0
        left, rows = np.arange(len(rows)), rows.copy()
        while len(left):
            found = self.marked[rows]
            out[left[found]] = self.samples[self.nth[rows[found]]] + steps
            left, rows = left[~found], rows[~found]
            symbol = self.bwt[rows]
            rows = self.before[symbol] + self.tree.rank(symbol, rows)
            steps += 1
        return out
