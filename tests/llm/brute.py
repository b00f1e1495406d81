"""Plain versions of the corpus operators, for small tables."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def repeats(docs, length):
    """Per key the sorted results of its rows: bytes, removed, spans, hash of what stays."""
    seen = Counter()
    for _, text in docs:
        data = (text or "").encode()
        seen.update(data[i : i + length] for i in range(len(data) - length + 1))
    out = {}
    for key, text in docs:
        data = (text or "").encode()
        covered = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if seen[data[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        kept = bytes(x for x, c in zip(data, covered) if not c)
        spans = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        out.setdefault(key, []).append((len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return {k: sorted(v) for k, v in out.items()}


def contamination(docs, items, size):
    windows = {}
    for key, text in items:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).update([] if key is None else [str(key)])
    out = []
    for key, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out.append((key, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def shingles(text, size=5):
    w = words(text)
    n = min(size, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def jaccard_classes(docs, threshold=0.8):
    """Rows of key, least key of the class, links, rows in the class."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))
    links = [0] * len(docs)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in where[x] if j > i)
        for j, n in shared.items():
            if n >= threshold * (len(s) + len(sets[j]) - n) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    classes = {}
    for i in range(len(docs)):
        classes.setdefault(root(i), []).append(docs[i][0])
    return sorted(
        ((docs[i][0], min((k for k in classes[root(i)] if k is not None), default=None), links[i], len(classes[root(i)])) for i in range(len(docs))), key=str)
