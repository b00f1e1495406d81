"""Word shingles of a text as sorted 64-bit hashes, and their MinHash bands."""

from __future__ import annotations

import numpy as np

from tidemark.llm.decontaminate import _TABLE
from tidemark.llm.substring_dedup import Hashes

_RANDOM = np.random.default_rng(7)
_PART = 4096


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Hashes of the distinct runs of `size` words; of fewer words, but not none, all make one run."""
    data = np.frombuffer(text.translate(_TABLE), np.uint8)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = data != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    words = np.empty(len(starts), np.uint64)
    step = 1 << 18  # words of a long text are hashed in parts
    for i in range(0, len(starts), step):
        a, b = starts[i : i + step], ends[i : i + step]
        words[i : i + step] = Hashes(data[a[0] : b[-1]]).of(a - a[0], b - a[0])
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[k : len(words) - size + 1 + k]
        out ^= out >> np.uint64(32)
    return np.unique(out)


class MinHash:
    """Least values of a set under random hashes, in bands of rows."""

    def __init__(self, bands: int, rows: int) -> None:
        random = np.random.default_rng(11)
        self.bands, self.rows = bands, rows
        self.a = random.integers(0, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = random.integers(0, 1 << 32, bands * rows, dtype=np.uint32)
        self.mix = random.integers(0, 1 << 63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def band_hashes(self, hashes: np.ndarray) -> np.ndarray:
        """A hash per band, which also tells the bands apart."""
        x = (hashes >> np.uint64(32)).astype(np.uint32)
        least = np.full(len(self.a), np.iinfo(np.uint32).max, np.uint32)
        for i in range(0, len(x), _PART):
            np.minimum(least, (self.a[:, None] * x[None, i : i + _PART] + self.b[:, None]).min(1), out=least)
        rows = least.reshape(self.bands, self.rows).astype(np.uint64) + np.uint64(1)
        out = (rows * self.mix).sum(1, dtype=np.uint64) + np.arange(self.bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
        out *= np.uint64(0x94D049BB133111EB)
        return (out ^ out >> np.uint64(29)).view(np.int64)


def bands_for(threshold: float, recall: float, hashes: int = 192) -> tuple[int, int]:
    """The most rows to a band, of about `hashes` rows in all, at which a pair at the threshold still meets often enough."""
    for rows in range(16, 0, -1):
        bands = hashes // rows
        if 1 - (1 - threshold**rows) ** bands >= recall:
            return bands, rows
    return hashes, 1
