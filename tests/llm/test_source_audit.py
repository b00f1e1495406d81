"""The audit against plain counting, on odd rows, and with small shards and parts."""

import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from tidemark.llm import source_audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, min_docs):
    """Rows of the audit of (text, lang, source)."""
    docs = [(t or "", g or "", s or "") for t, g, s in docs]
    spread, count = Counter(), defaultdict(Counter)
    for text, lang, source in docs:
        count[lang, source].update(terms(text))
        spread.update({(lang, w) for w in terms(text)})
    out = []
    for lang in {g for _, g, _ in docs}:
        kept = sorted((w for g, w in spread if g == lang and spread[g, w] >= min_docs), key=str.encode)
        sources = [s for g, s in count if g == lang]
        of = {s: {w: count[lang, s][w] for w in kept} for s in sources}
        of[None] = {w: sum(of[s][w] for s in sources) for w in kept}
        share = {s: {w: 1 + 10**9 * (n + 5) // (sum(c.values()) + 5 * len(kept)) for w, n in c.items()} for s, c in of.items()}
        for s in sources:
            pairs = [(sum(abs(share[s][w] - share[o][w]) for w in kept), o) for o in sources if o != s]
            more = [(share[s][w] - share[None][w], w) for w in kept if of[s][w] and share[s][w] > share[None][w]]
            for part, rows, most in (("pair", pairs, None), ("term", more, 50)):
                ranked = sorted(rows, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


SCHEMA = "text string, lang string, source string, n long, rank int, shard int"


def frame(spark, docs):
    return spark.createDataFrame([(*d, 1, 2, 3) for d in docs], SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("cells", [1 << 20, 8])
def test_like_plain_counting(spark, cells):
    words = ["Alpha", "beta", "é", "ÉA", "日本", "x\x00y", "ALPHA"]
    docs = [(" ".join(words[(i * k + k * k) % 7] for k in range(1 + i % 6)), "en" if i % 3 else "fr", f"s{i % 4}") for i in range(80)]
    docs += [(None, "en", "s1"), ("", None, None), ("only here", "xx", "a"), ("", "xx", "b"), (None, "xx", "c"), ("1 2 .", "en", "nothing")]
    docs += [docs[0]] * 5
    assert rows(source_audit.audit(frame(spark, docs), min_docs=5, cells=cells)) == plain(docs, 5)


def test_empty_table(spark):
    assert rows(source_audit.audit(frame(spark, [])))  == []


def test_long_texts_are_counted_in_parts():
    text = "Über a b2c " * 500
    batch = pa.RecordBatch.from_pydict({"text": [text, "a a", ""], "lang": ["l"] * 3, "source": ["s"] * 3})
    whole = pa.Table.from_batches(source_audit.partial_counts(iter([batch])))
    parts = pa.Table.from_batches(source_audit.partial_counts(iter([batch]), limit=64))
    total = lambda t: sorted(map(tuple, (r.values() for r in t.group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")]).to_pylist())), key=str)
    assert total(whole) == total(parts)
    assert ("l", "s", "a", 502, 2) in total(whole)


def test_shares_are_exact_beyond_64_bits():
    import numpy as np

    for count, total, kept in ((10**14 + 7, 3 * 10**14 + 1, 10**6), (0, 9 * 10**14, 3), (5, 5, 1)):
        assert source_audit.scaled_share(np.array([count]), total, kept).tolist() == [1 + 10**9 * (count + 5) // (total + 5 * kept)]
