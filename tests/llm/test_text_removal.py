"""Repeated strings, benchmark windows and similar texts against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from tests.llm import brute
from tidemark.llm import decontaminate as D
from tidemark.llm import jaccard_join as J
from tidemark.llm import substring_dedup as S
from tidemark.llm.bwt import repeated_starts
from tidemark.llm.fmindex import FMIndex
from tidemark.llm.graph import components
from tidemark.llm.shingles import bands_for
from tidemark.llm.substring_dedup import remove_repeats, remove_repeats_from_texts
from tidemark.llm.suffixes import suffix_array, told_apart

SCHEMA = "doc_id long, text string, key string, r1 int, name int, row int"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "clash", -1, -2, -3) for k, t in rows], SCHEMA)


def copies(seed=5, n=40):
    rng = random.Random(seed)
    base = "".join(rng.choice("abé ") for _ in range(300))
    rows = []
    for i in range(n):
        a = rng.randrange(250)
        part = list(base[a : a + rng.randrange(120)])
        for _ in range(rng.randrange(3)):
            if part:
                part[rng.randrange(len(part))] = rng.choice("xyz")
        rows.append((i, "".join(rng.choice("abé ") for _ in range(rng.randrange(30))) + "".join(part)))
    return [*rows, (3, rows[3][1]), (None, None), (None, "a" * 60), (98, ""), (99, None), (100, "a" * 3000)]


def test_suffix_array():
    rng = np.random.default_rng(0)
    for _ in range(60):
        t = rng.integers(0, 3, rng.integers(0, 60))
        assert suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


def test_repeated_starts():
    rng = random.Random(3)
    for _ in range(150):
        length, signs = rng.choice([1, 2, 3, 5, 9]), rng.choice([b"ab", b"abc\0", bytes(range(6))])
        base = bytes(rng.choice(signs) for _ in range(60))
        parts = []
        for _ in range(rng.randrange(1, 6)):
            a = rng.randrange(50)
            parts.append(bytes(rng.choice(signs) for _ in range(rng.randrange(20))) + base[a : a + rng.randrange(40)])
        seen = Counter(p[i : i + length] for p in parts for i in range(len(p) - length + 1))
        wanted = [[i for i in range(len(p) - length + 1) if seen[p[i : i + length]] > 1] for p in parts]
        assert [x.tolist() for x in repeated_starts(parts, length)] == wanted


@pytest.mark.parametrize("length, cap", [(20, 300), (20, 3), (3, 2)])
def test_repeats(spark, length, cap):
    docs = copies()
    got = {}
    for r in remove_repeats(frame(spark, docs), length=length, cap=cap).collect():
        got.setdefault(r[0], []).append(tuple(r)[1:])
    assert {k: sorted(v) for k, v in got.items()} == brute.repeats(docs, length)


def test_repeats_in_texts(spark):
    docs = copies(n=10)
    out = remove_repeats_from_texts(frame(spark, docs), length=20)
    assert out.columns == ["doc_id", "text", "key", "r1", "name", "row"]
    kept = out.collect()
    assert len(kept) == len(docs) and {r["key"] for r in kept} == {"clash"}
    assert sorted(len((r["text"] or "").encode()) for r in kept) <= sorted(len((t or "").encode()) for _, t in docs)
    assert remove_repeats(frame(spark, [])).collect() == []


def test_anchors_do_not_depend_on_segments(monkeypatch):
    data = np.random.default_rng(1).integers(0, 3, 5000).astype(np.uint8)

    def found(segment):
        monkeypatch.setattr(S, "_SEGMENT", segment)
        return [tuple(x) for key, near, lo, _ in S.find_anchors(data, 20) for x in zip(key.tolist(), near.tolist(), lo.tolist())]

    assert found(64) == found(7) == found(1) == found(1 << 18)


def noise(rng, n):
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))


def test_nothing_is_cut_where_segments_meet(spark):
    rng = random.Random(11)
    big = noise(rng, 620_000)
    docs = [(0, big), (1, noise(rng, 50) + big[300_000:300_150] + noise(rng, 50))]
    got = {r[0]: [tuple(r)[1:]] for r in remove_repeats(frame(spark, docs), length=100).collect()}
    assert got == brute.repeats(docs, 100)


def test_nothing_is_cut_where_halves_meet(spark):
    rng, docs = random.Random(11), []
    for i in range(60):
        shared = noise(rng, 19)
        docs += [(100 * i + j, noise(rng, 40) + shared + noise(rng, 40)) for j in range(8)]
    got = {r[0]: [tuple(r)[1:]] for r in remove_repeats(frame(spark, docs), length=20, cap=3).collect()}
    assert got == brute.repeats(docs, 20)


def test_hot_anchors_do_not_read_documents_again(spark):
    rng, docs = random.Random(12), []
    for i in range(6):
        shared = noise(rng, 25)
        docs += [(100 * i + j, noise(rng, 40) + shared + noise(rng, 40)) for j in range(8)]

    def rows_read(cap):
        read = spark.sparkContext.accumulator(0)

        def count(batches):
            for batch in batches:
                read.add(batch.num_rows)
                yield batch

        table = frame(spark, docs)
        got = {r[0]: [tuple(r)[1:]] for r in remove_repeats(table.mapInArrow(count, table.schema), length=20, cap=cap).collect()}
        assert got == brute.repeats(docs, 20)
        return read.value

    assert rows_read(3) == rows_read(1000) == 3 * len(docs)


def test_the_sort_tells_rows_apart():
    rng = np.random.default_rng(7)
    for length in (1, 3, 20, 40):
        base = rng.integers(1, 4, 60)
        text = np.concatenate([base, [0], base[10:55], [0], rng.integers(1, 4, 50), [0]])
        sa, apart, told = told_apart(text, length)
        assert told <= length and sa.tolist() == suffix_array(text, length).tolist()
        if told:
            heads = [text[i : i + told].tolist() for i in sa]
            assert apart.tolist() == [True, *(a != b for a, b in zip(heads, heads[1:]))]


def test_added_bytes():
    rng = random.Random(4)
    for _ in range(200):
        stretches, seen = [], set()
        for _ in range(30):
            first = rng.randrange(200)
            end = first + rng.randrange(1, 30)
            new = set(range(first, end)) - seen
            assert S.added(stretches, first, end) == len(new)
            seen |= new
            assert {i for a, b in stretches for i in range(a, b)} == seen
            assert all(x[1] < y[0] for x, y in zip(stretches, stretches[1:]))


def test_shards_are_bounded_in_any_order():
    rng = random.Random(6)
    rows = [{"key": k, "r1": d, "r2": 0, "first": a + 7 * d, "piece": b"x" * 600} for k, a in enumerate(range(0, 100_000, 100)) for d in range(2)]
    for order in (lambda r: r["key"], lambda r: -r["key"], lambda r: hash((r["key"] // 40, 5))):
        rows.sort(key=order)
        runs = list(S.shards(iter(rows), 10_000, 500))
        assert [r for run in runs for r in run] == rows
        for run in runs:
            covered = {(r["r1"], i) for r in run for i in range(r["first"], r["first"] + 600)}
            assert len(covered) < 10_000 + 2 * 600 and len(run) <= 501
        assert not {r["key"] for r in runs[0]} & {r["key"] for r in runs[1]}
    one = [{"key": 1, "r1": rng.randrange(9), "r2": 0, "first": 0, "piece": b"y" * 600} for _ in range(700)]
    assert [len(run) for run in S.shards(iter(one), 10_000, 500)] == [700]


def test_long_copies_with_passages_in_another_order(spark, monkeypatch):
    rng = random.Random(6)
    big = noise(rng, 300_000)
    parts = [big[i : i + 3000] for i in range(0, len(big), 3000)]
    rng.shuffle(parts)
    docs = [(0, big), (1, "x" + big + "tail"), (2, "".join(parts))]
    monkeypatch.setattr(S, "SHARD_BYTES", 40_000)
    got = {r[0]: [tuple(r)[1:]] for r in remove_repeats(frame(spark, docs), length=100).collect()}
    assert got == brute.repeats(docs, 100)


def test_fm_index():
    rng = np.random.default_rng(0)
    for _ in range(30):
        t = np.concatenate([np.append(rng.integers(0, 4, rng.integers(1, 40)), 0) for _ in range(3)])
        index = FMIndex(t, 4)
        for m in (1, 2, 3):
            patterns = rng.integers(1, 6, (5, m))
            for p, a, b in zip(patterns, *index.search(patterns)):
                assert sorted(index.locate(np.arange(a, b)).tolist()) == [i for i in range(len(t) - m + 1) if (t[i : i + m] == p).all()]


@pytest.mark.parametrize("how", [{}, {"shard_words": 40}, {"block_bytes": 200}])
def test_contamination(spark, how):
    rng = random.Random(8)
    item = [rng.choice("abcdefgh") for _ in range(30)]
    items = [(1, " ".join(item)), (10, "Short One"), (2, None), (3, ""), (None, "only here now"), (1, " ".join(item)), (4, "it's a Größe test of ten words and one more word"), (5, "short one")]
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(60)))) for i in range(20)]
    docs += [(30, "x, " + ", ".join(item[3:20]) + ", y"), (31, "SHORT\none"), (32, None), (33, ""), (34, "only here now"), (35, "It's a größe Test of ten words and one more, word"), (30, " ".join(item)), (None, " ".join(item * 40)), (36, "a " * 500)]
    table = spark.createDataFrame([(k, t, 0) for k, t in items], "item_id long, text string, key int")
    got = D.report(D.find(frame(spark, docs), table, **how))
    assert sorted(map(tuple, got.collect()), key=str) == brute.contamination(docs, items, 10)


def test_decontaminated_texts(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id long, text string")
    docs = [(1, "Start. Alpha, beta gamma delta epsilon zeta eta theta iota (kappa) end."), (2, "clean text"), (3, None)]
    out = D.decontaminate(frame(spark, docs), items)
    assert out.columns == ["doc_id", "text", "key", "r1", "name", "row"]
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "Start. ) end.", 2: "clean text", 3: None}
    assert D.decontaminate(frame(spark, []), items).collect() == []
    assert D.decontaminate(frame(spark, docs), items.limit(0)).count() == 3
    assert D.find(frame(spark, docs), items.limit(0)).count() == 3


def similar():
    rng = random.Random(2)
    base = [rng.choice("abcdefghij") + rng.choice("klmnop") + str(rng.randrange(50)) for _ in range(120)]
    rows = []
    for i in range(100):
        w = list(base)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(120)] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(w)))
    return [*rows, (200, ""), (201, None), (202, "!!"), (203, "one two"), (204, "One, two."), (5, rows[5][1]), (None, "one two"), (205, "p q r s t u"), (206, rows[5][1].upper())]


@pytest.mark.parametrize("block", [96, 7])
def test_jaccard_join(spark, block):
    docs = similar()
    got = J.join(frame(spark, docs), block=block).select("doc_id", "class_id", "n_links", "n_class").collect()
    assert sorted(map(tuple, got), key=str) == brute.jaccard_classes(docs)


def test_keep_one(spark):
    docs = similar()
    out = J.keep_one(frame(spark, docs))
    assert out.columns == ["doc_id", "text", "key", "r1", "name", "row"]
    classes = {r[1] for r in brute.jaccard_classes(docs)}
    assert sorted(r["doc_id"] for r in out.select("doc_id").collect()) == sorted(classes)
    assert J.join(frame(spark, [])).collect() == []


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.9999), (0.5, 0.99)):
        bands, rows = bands_for(threshold, recall)
        assert 1 - (1 - threshold**rows) ** bands >= recall


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
