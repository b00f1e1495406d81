"""FM-index of one bounded shard of symbols: wavelet ranks, backward search, sampled suffix positions."""

from __future__ import annotations

import numpy as np

from tidemark.llm.suffixes import suffix_array

SAMPLE = 16


class Bits:
    """A bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64)


class WaveletMatrix:
    """Ranks of any symbol in a sequence, one bit vector per bit of the symbols."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in range(bits - 1, -1, -1):
            ones = (symbols >> shift & 1).astype(bool)
            zeros = len(symbols) - int(ones.sum())
            self.levels.append((shift, Bits(ones), zeros))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        start = np.zeros_like(i)
        for shift, ones, zeros in self.levels:
            high = (symbol >> shift & 1).astype(bool)
            a, b = ones.rank(start), ones.rank(i)
            start = np.where(high, zeros + a, start - a)
            i = np.where(high, zeros + b, i - b)
        return i - start

    def access_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position and its occurrences before it."""
        symbol, start = np.zeros_like(i), np.zeros_like(i)
        for _, ones, zeros in self.levels:
            bit = ones.get(i)
            high = bit.astype(bool)
            a, b = ones.rank(start), ones.rank(i)
            start = np.where(high, zeros + a, start - a)
            i = np.where(high, zeros + b, i - b)
            symbol = symbol << 1 | bit
        return symbol, i - start


class FMIndex:
    """Index of a sequence of symbols >= 0; the sequence must end with its only kind of separator, 0."""

    def __init__(self, text: np.ndarray, sample: int = SAMPLE) -> None:
        # a sign below all others ends the text, so the rotation order is the suffix order
        text = np.concatenate([text.astype(np.int64) + 1, [0]])
        sa = suffix_array(text)
        self.size = len(text)
        bits = max(1, int(text.max()).bit_length())
        self.tree = WaveletMatrix(text[sa - 1], bits)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << bits))])
        sampled = sa % sample == 0
        self.sampled = Bits(sampled)
        self.samples = sa[sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals [lo, hi) of equally long patterns, one per row."""
        patterns = patterns.astype(np.int64) + 1
        lo = np.zeros(len(patterns), np.int64)
        hi = np.full(len(patterns), self.size, np.int64)
        alive = np.flatnonzero((patterns < len(self.before) - 1).all(1)) if len(patterns) else np.zeros(0, np.int64)
        dead = np.ones(len(patterns), bool)
        dead[alive] = False
        hi[dead] = 0
        for column in range(patterns.shape[1] - 1, -1, -1):
            if not len(alive):
                break
            symbol = patterns[alive, column]
            both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([lo[alive], hi[alive]]))
            lo[alive] = self.before[symbol] + both[: len(alive)]
            hi[alive] = self.before[symbol] + both[len(alive) :]
            alive = alive[lo[alive] < hi[alive]]
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, by walking back to a sampled one."""
        out = np.zeros(len(rows), np.int64)
        todo, at, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(todo):
            hit = self.sampled.get(at).astype(bool)
            out[todo[hit]] = self.samples[self.sampled.rank(at[hit])] + steps
            todo, at = todo[~hit], at[~hit]
            if len(todo):
                symbol, rank = self.tree.access_rank(at)
                at = self.before[symbol] + rank
            steps += 1
        return out
