"""Collocations against plain counting; parts of long texts; the compaction of paths."""

import re
from collections import Counter

import pyarrow as pa
import pytest

from tidemark.llm import collocations as C


def pieces_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def plain(docs, least, top):
    out = []
    for lang in {g or "und" for _, g in docs}:
        f = Counter()
        for text, g in docs:
            if (g or "und") == lang:
                for w in pieces_of(text):
                    f.update(tuple(w[i : i + k]) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
        n = sum(c for g, c in f.items() if len(g) == 1)
        often = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        hidden = {d[i : i + k] for d, a in often.items() for k in range(2, len(d)) for i in range(len(d) - k + 1) if 100 * a >= 80 * often[d[i : i + k]]}
        scored = []
        for g, a in often.items():
            if g not in hidden:
                score, _, left, right = min((2000000 * a // (f[g[:k]] + f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
                scored.append((-score, -a, " ".join(g).encode(), left, right))
        out += [(lang, rank, p.decode(), -a, left, right, n, -s) for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def rows(df):
    return sorted(map(tuple, df.collect()))


def corpus(seed, size):
    import random

    rng = random.Random(seed)
    words = ["New", "york", "is", "big", "É", "日本", "a", "b\x00", "of", "THE"]
    fixed = ["to be or not to be that is", "a a a a a a", "one two three", "x y", "alpha beta gamma delta eps zeta eta"]
    text = lambda: "".join(rng.choice([rng.choice(words), rng.choice(fixed)]) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ",", " ; "]) for _ in range(rng.randint(0, 30)))
    return [(text(), rng.choice(["en", "en", "f r%20\t%", None])) for _ in range(size)]


SCHEMA = "text string, lang string, phrase string, words int, f long"


@pytest.mark.parametrize("rounds", [0, 1, 4])
def test_like_plain_counting(spark, rounds, monkeypatch):
    monkeypatch.setattr(C, "HOT", 4 if rounds == 1 else 512)
    docs = corpus(rounds, 120) + [(None, "en"), ("", None), (" .,!\t", "fr"), ("lonely", "xx")]
    docs += [docs[0]] * 40
    df = spark.createDataFrame([(*d, "clash", 1, 2) for d in docs], SCHEMA)
    assert rows(C.collocations(df, least=5, top=50, rounds=rounds)) == plain(docs, 5, 50)


def test_empty_table(spark):
    assert rows(C.collocations(spark.createDataFrame([], SCHEMA))) == []


@pytest.mark.parametrize("limit", [1, 7, 40, 300])
def test_long_texts_are_counted_in_parts(limit):
    text = ". ".join(t for t, _ in corpus(9, 20)) + " run on " * 60 + "word " * 9 + "   , end"
    batch = pa.RecordBatch.from_pydict({"text": [text, "short text"], "lang": ["l", "l"]})

    def total(limit):
        found = Counter()
        for b in C.partial_edges(iter([batch]), limit):
            for r in b.to_pylist():
                found[r["gram"]] += r["f"]
        return found

    wanted = Counter()
    for t in (text, "short text"):
        for w in pieces_of(t):
            wanted.update("l\t" + " ".join([*w[i : i + 4], ""]) for i in range(len(w) - 3))
            wanted.update("l\t" + " ".join([*w[-k:], ""]) for k in range(1, min(3, len(w)) + 1))
    assert total(limit) == wanted


def test_unary_paths_are_compacted(spark):
    text = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([(text, "en")] * 6 + [("w5 w6 w7 other", "en")], "text string, lang string")
    often = C.frequent(df, 5).cache()
    f = {r["phrase"]: r["f"] for r in often.collect()}
    edges = [("en", p, n, f[" ".join(p.split()[:3])], f[" ".join(p.split()[1:])]) for p, n in f.items() if len(p.split()) == 4]
    paths = rows(C.compact(spark.createDataFrame(edges, "lang string, path string, f long, f_head long, f_tail long"), 12).select("path"))
    parts = [p[0].split() for p in paths]
    # w5 w6 w7 also leads elsewhere: the paths end there
    assert len(parts) == 2 and sorted(map(len, parts)) == [8, 15] and {p[0] for p in parts} == {"w0", "w5"}
