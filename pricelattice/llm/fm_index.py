"""An FM-index over integer symbols: backward search through the ranks of a wavelet matrix."""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in lexicographic order, by prefix doubling.

    A round sorts by twice the prefix length of the one before and only touches suffixes that are still tied.
    """
    n = len(symbols)
    if n < 2:
        return np.arange(n)
    following = np.zeros(n, np.int64)
    following[:-1] = symbols[1:].astype(np.int64) + 1
    key = symbols.astype(np.int64) * (int(symbols.max()) + 2) + following
    order = np.argsort(key)
    rank = np.empty(n, np.int64)
    new = np.flatnonzero(np.diff(key[order], prepend=key[order[0]] - 1))
    sizes = np.diff(new, append=n)
    rank[order] = np.repeat(new, sizes)
    tied = np.repeat(sizes > 1, sizes)
    length = 2
    while tied.any():
        places = np.flatnonzero(tied)  # slots of `order`, tied groups side by side
        at = order[places]
        ahead = at + length
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        resorted = np.lexsort((second, rank[at]))
        at, second, group = at[resorted], second[resorted], rank[at][resorted]
        order[places] = at
        head = np.ones(len(at), bool)
        head[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        new = np.flatnonzero(head)
        sizes = np.diff(new, append=len(at))
        rank[at] = np.repeat(places[new], sizes)
        tied[places] = np.repeat(sizes > 1, sizes)
        length *= 2
    return order


class Bits:
    """A bit vector with ranks: packed bits and a count before each 64-bit word."""

    def __init__(self, bits: np.ndarray) -> None:
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        packed = np.packbits(bits, bitorder="little")
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class WaveletMatrix:
    """Symbols bit by bit, highest first; each level is stably split by its bit."""

    def __init__(self, symbols: np.ndarray, largest: int) -> None:
        self.levels = []
        for shift in range(max(1, int(largest).bit_length()) - 1, -1, -1):
            bits = (symbols >> shift) & 1 == 1
            self.levels.append((shift, Bits(bits)))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        low, high = np.zeros_like(at), at
        for shift, bits in self.levels:
            one = (symbols >> shift) & 1 == 1
            ones_low, ones_high = bits.ones(low), bits.ones(high)
            low = np.where(one, bits.zeros + ones_low, low - ones_low)
            high = np.where(one, bits.zeros + ones_high, high - ones_high)
        return high - low

    def step(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol at each position, and its occurrences before it."""
        symbol, low, here = np.zeros_like(at), np.zeros_like(at), at
        for shift, bits in self.levels:
            one = bits.get(here)
            symbol |= one.astype(np.int64) << shift
            ones_low, ones_here = bits.ones(low), bits.ones(here)
            low = np.where(one, bits.zeros + ones_low, low - ones_low)
            here = np.where(one, bits.zeros + ones_here, here - ones_here)
        return symbol, here - low


class FMIndex:
    """Search for symbol sequences in one text of symbols from 1 up; 0 ends the text.

    Every ``sample``-th suffix position is kept; others are found by walking back to one.
    """

    def __init__(self, symbols: np.ndarray, sample: int = 16) -> None:
        text = np.append(symbols, 0).astype(np.int64)
        self.size, self.largest, self.sample = len(text), int(text.max(initial=0)), sample
        order = suffix_order(text)
        last = text[order - 1]  # the symbol before each suffix; the whole text's is the end mark
        self.less = np.zeros(self.largest + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=self.largest + 1), out=self.less[1:])
        self.wavelet = WaveletMatrix(last, self.largest)
        kept = order % sample == 0
        self.kept, self.positions = Bits(kept), order[kept]

    def ranges(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix range [from, to) of each pattern; row i holds ``lengths[i]`` symbols, left-aligned."""
        start, stop = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        for back in range(int(lengths.max(initial=0))):
            live = np.flatnonzero((lengths > back) & (start < stop))
            if not len(live):
                break
            symbol = patterns[live, lengths[live] - 1 - back]
            known = (symbol > 0) & (symbol <= self.largest)
            stop[live[~known]] = start[live[~known]]
            live, symbol = live[known], symbol[known]
            start[live] = self.less[symbol] + self.wavelet.rank(symbol, start[live])
            stop[live] = self.less[symbol] + self.wavelet.rank(symbol, stop[live])
        return start, np.maximum(stop, start)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each suffix row."""
        out, walked = np.zeros(len(rows), np.int64), 0
        live, at = np.arange(len(rows)), rows.astype(np.int64)
        while len(live):
            found = self.kept.get(at)
            out[live[found]] = self.positions[self.kept.ones(at[found])] + walked
            live, at = live[~found], at[~found]
            symbol, before = self.wavelet.step(at)
            at = self.less[symbol] + before
            walked += 1
        return out
