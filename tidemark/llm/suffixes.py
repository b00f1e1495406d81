"""Suffix sorting of one bounded shard by prefix doubling."""

from __future__ import annotations

import numpy as np

#: Symbols of a shard at most.
MAX_SYMBOLS = 1 << 22
#: Up to so many, a rank, a second rank and a slot fit one 64-bit sort key.
_SLOT = 20


def suffix_array(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Positions of the suffixes in order; what lies past the end is smaller than any symbol.

    With `depth`, only that many first symbols need to be in order (the rest is
    left in any order), which is all that prefixes up to `depth` ask for.
    """
    return told_apart(text, depth)[0]


def told_apart(text: np.ndarray, depth: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """The suffix array, whether each row differs from the row before in its first symbols, and in how many at most `depth`."""
    n = len(text)
    if n > MAX_SYMBOLS:
        raise ValueError(f"a shard holds at most {MAX_SYMBOLS} symbols")
    apart, told = np.zeros(n, bool), 0
    if n == 0:
        return np.zeros(0, np.int64), apart, told
    bits = max(1, int(text.max() + 1).bit_length())
    h = max(1, (63 - _SLOT) // bits)
    key = np.zeros(n, np.int64)
    for k in range(h):
        key <<= bits
        key[: max(0, n - k)] |= text[k:].astype(np.int64) + 1
    order, key = _sorted(key)
    sa = order
    rank = np.empty(n, np.int64)
    slots = np.arange(n)
    while True:
        new = np.empty(len(key), bool)
        new[0] = True
        np.not_equal(key[1:], key[:-1], out=new[1:])
        if depth is None or h <= depth:
            apart[slots[new]] = True
            told = h
        rank[sa[slots]] = np.maximum.accumulate(np.where(new, slots, 0))
        alone = new.copy()
        alone[:-1] &= new[1:]
        slots = slots[~alone]
        if not len(slots) or (depth is not None and h >= depth):
            return sa, apart, told
        at = sa[slots]
        ahead = at + h
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        order, key = _sorted(rank[at] * (n + 1) + second)
        sa[slots] = at[order]
        h *= 2


def _sorted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys and the keys in order; a packed sort is several times faster than an indirect one."""
    n = len(key)
    if n <= 1 << _SLOT and key.max() < 1 << (63 - _SLOT):
        packed = np.sort((key << _SLOT) | np.arange(n))
        return packed & ((1 << _SLOT) - 1), packed >> _SLOT
    order = np.argsort(key, kind="stable")
    return order, key[order]
