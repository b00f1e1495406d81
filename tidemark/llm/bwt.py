"""Repeated strings of one bounded shard, by interval expansion on its Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np

from tidemark.llm.suffixes import told_apart

#: Wider intervals ask each symbol's list of rows; narrower ones look at their rows.
_WIDE = 24


def short_boundaries(text: np.ndarray, sa: np.ndarray, length: int, apart: np.ndarray | None = None, told: int = 0) -> np.ndarray:
    """For each row of the suffix array, whether it shares fewer than `length` symbols with the row before.

    Starting from the intervals of single symbols, or of all strings of `told` symbols where the sort
    has told rows `apart` by so many, every interval of a string
    is extended to the left by each symbol found before it. The right end of an interval of
    strings of length k + 1 that no shorter string has ended at has a common
    prefix of k with its neighbour, so prefixes come out by increasing value,
    and the search stops before `length`. Symbol 0 separates texts: strings may end with it
    but aren't extended by it, so prefixes across it count as short or stay unset, and
    must not be asked for.
    """
    n = len(text)
    bwt = text[sa - 1]
    symbols = int(text.max()) + 1
    starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
    by_symbol = np.argsort(bwt, kind="stable")
    lf = np.empty(n, np.int64)
    lf[by_symbol] = np.arange(n)
    rows_of = [by_symbol[starts[c] : starts[c + 1]] for c in range(symbols)]
    first = text[sa]
    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    if told:
        known[:n] |= apart
        lo = np.flatnonzero(known[:n])
        hi = np.append(lo[1:], n)
    else:
        lo, hi = starts[:-1], starts[1:]
        some = hi > lo
        lo, hi = lo[some].astype(np.int64), hi[some].astype(np.int64)
        known[hi] = True
    for _ in range(max(1, told), length):
        if not len(lo):
            break
        width = hi - lo
        found_lo, found_hi = [], []
        one = lo[width == 1]
        one = lf[one[bwt[one] != 0]]
        one = one[~known[one + 1]]
        found_lo.append(one)
        found_hi.append(one + 1)
        some = np.flatnonzero((width > 1) & (width <= _WIDE))
        if len(some):
            w = width[some]
            at = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w) + np.repeat(lo[some], w)
            owner = np.repeat(np.arange(len(some)), w)
            keep = bwt[at] != 0
            # rows before which one symbol stands go to neighbouring rows, in the same order
            packed = np.sort(owner[keep] << 23 | lf[at[keep]])
            if len(packed):
                to = packed & (1 << 23) - 1
                new = np.empty(len(packed), bool)
                new[0] = True
                new[1:] = (packed[1:] != packed[:-1] + 1) | (first[to[1:]] != first[to[:-1]])
                begin = np.flatnonzero(new)
                a, b = to[begin], to[np.concatenate([begin[1:] - 1, [len(to) - 1]])] + 1
                fresh = ~known[b]
                found_lo.append(a[fresh])
                found_hi.append(b[fresh])
        wide = np.flatnonzero(width > _WIDE)
        if len(wide):
            for c in range(1, symbols):
                a = np.searchsorted(rows_of[c], lo[wide])
                b = np.searchsorted(rows_of[c], hi[wide])
                some = a < b
                a, b = a[some] + starts[c], b[some] + starts[c]
                fresh = ~known[b]
                found_lo.append(a[fresh])
                found_hi.append(b[fresh])
        lo, hi = np.concatenate(found_lo), np.concatenate(found_hi)
        if len(hi):
            # several strings can first end at one row in the same round: the widest stands for them
            order = np.lexsort((lo, hi))
            lo, hi = lo[order], hi[order]
            keep = np.concatenate([[True], hi[1:] != hi[:-1]])
            lo, hi = lo[keep], hi[keep]
            known[hi] = True
    return known[:n]


def repeated_starts(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """For each piece, its positions where a string of `length` bytes starts that also starts elsewhere in the pieces."""
    data = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    sizes = np.array([len(p) for p in pieces])
    begin = np.cumsum(sizes + 1) - sizes - 1
    used = np.zeros(256, np.int64)
    used[data] = 1
    alphabet = np.cumsum(used)
    text = alphabet[data]
    text[begin + sizes] = 0
    sa, apart, told = told_apart(text, length)
    long = np.flatnonzero(~short_boundaries(text, sa, length, apart, told))
    fits = np.zeros(len(text), bool)
    for b, s in zip(begin.tolist(), sizes.tolist(), strict=True):
        fits[b : b + max(0, s - length + 1)] = True
    starts = np.zeros(len(text), bool)
    pair = long[fits[sa[long]] & fits[sa[long - 1]]]
    starts[sa[pair]] = True
    starts[sa[pair - 1]] = True
    return [np.flatnonzero(starts[b : b + s]) for b, s in zip(begin.tolist(), sizes.tolist(), strict=True)]
