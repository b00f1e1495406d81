"""Search, toxicity, quality and language: exact parts against brute force, learned parts by held-out accuracy."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_id as L
from tidemark.llm import quality as Q
from tidemark.llm import toxicity as X
from tidemark.llm.hamming_search import SubstringIndex, learn_codes, search
from tidemark.llm.logistic import Logistic

SMALL = "/root/testdata/sf0.01"


def table(spark, name, folder=SMALL):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def nearest(vectors, ids, every, k):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        cosine = unit @ unit[i]
        order = sorted((j for j in range(len(ids)) if ids[j] != ids[i]), key=lambda j: (-round(cosine[j], 12), ids[j]))
        out[int(ids[i])] = [(int(ids[j]), cosine[j]) for j in order[:k]]
    return out


def test_substring_index_finds_every_code_in_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 20, 300, dtype=np.uint64)
    for parts, radius in ((4, 3), (4, 6), (3, 0), (5, 20)):
        found = SubstringIndex(codes, 20, parts).within(codes[:40], radius)
        assert (found == (np.bitwise_count(codes[:40][:, None] ^ codes) <= radius)).all()


def test_recall_of_the_search(spark):
    rows = table(spark, "embeddings")
    local = rows.toPandas()
    wanted = nearest(np.stack(local.embedding).astype("f8"), local.vec_id.to_numpy(), 50, 5)
    got = {}
    for r in search(rows, shard=100, block=4).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(wanted)
    hits = sum(len({v for _, v, _ in found} & {v for v, _ in wanted[q]}) for q, found in got.items())
    assert hits >= 0.9 * 5 * len(wanted)
    assert all([r for r, _, _ in sorted(found)] == [1, 2, 3, 4, 5] for found in got.values())


def test_search_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [1.0, 2.0]), (1, [2.0, 4.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [None, 1.0]), (6, [1.0]), (None, [1.0, 1.0]), (7, [1e200, 1e200]), (0, [1.0, 2.0]), (100, [-1.0, 0.5]), (8, [inf, 1.0]), (9, [])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, v string, ids int")
    got = {}
    for r in sorted(search(df).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 9)))
    assert got[0] == [(1, 1.0), (50, 1.0), (7, round(3 / np.sqrt(10), 9)), (100, 0.0)]
    assert got[50] == [(0, 1.0), (1, 1.0), (7, round(3 / np.sqrt(10), 9)), (100, 0.0)]
    assert [v for v, _ in got[100]] == [0, 1, 50, 7] and set(got) == {0, 50, 100}
    assert search(df.limit(0)).collect() == []


def test_a_vector_of_most_rows_is_one_entry(spark):
    rows = [(i, [1.0, 0.5, 0.25]) for i in range(300)] + [(1000 + i, [float(i), 1.0, 0.0]) for i in range(1, 20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in search(df).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert [v for _, v in sorted(got[0])] == [1, 2, 3, 4, 5] and [v for _, v in sorted(got[50])] == [0, 1, 2, 3, 4]


def test_codes_of_few_vectors():
    assert learn_codes(np.array([[1.0, 2.0]]), 5).radius >= 0


def test_block_max_index_is_exact():
    rng = np.random.default_rng(0)
    vectors, dense = [], np.zeros((400, 40))
    for i in range(400):
        t = np.sort(rng.choice(40, rng.integers(1, 6), replace=False))
        w = rng.random(len(t))
        w /= np.sqrt(w @ w)
        vectors.append((t, w))
        dense[i, t] = w
    index = X.BlockMaxIndex(vectors, 40, 16)
    for i in range(50):
        scores = np.round(dense @ dense[i], 12)
        wanted = [int(x) for x in np.lexsort((np.arange(400), -scores))[:9] if scores[x] > 0]
        assert [x for _, x in index.search(*vectors[i], 9)] == wanted


def test_toxicity_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, "documents", folder), table(spark, "labels", folder)
    found = X.score(docs, X.fit(docs, labels)).join(labels, "doc_id").where("held_out").toPandas()
    assert (found.predicted == found.toxic).mean() > 0.97
    assert found[found.toxic == 1].predicted.mean() > 0.85
    assert found.score.between(0, 1).all() and ((found.score >= 0.5) == (found.predicted == 1)).all()


def test_toxicity_on_held_out_documents_of_a_small_table(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    model = X.fit(docs, labels)
    found = X.score(docs, model).join(labels, "doc_id").where("held_out and toxic = 1").toPandas()
    assert found.evidence.map(len).min() > 0 and found.predicted.mean() > 0.6
    words = {w for r in docs.join(labels.where(~X.held_out("doc_id")), "doc_id").select("text").collect() for w in X.split_words((r["text"] or "").encode())}
    assert {X.hash_of(w, model.vocabulary.seed) for w in words} <= set(model.vocabulary.hashes.tolist())


def test_toxicity_scores_and_evidence_by_brute_force(spark):
    """Votes of the nearest by all cosines of plain TF-IDF vectors, then the model's own calibration."""
    docs, labels = table(spark, "documents"), table(spark, "labels")
    model = X.fit(docs, labels, k=7)
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    marked = {r["doc_id"]: int(r["toxic"] > 0) for r in labels.collect() if r["toxic"] is not None and r["doc_id"] in texts and zlib.crc32(str(r["doc_id"]).encode()) % 5}
    terms = {k: Counter(t for w in X.split_words(v) for t in X.terms_of(w)) for k, v in texts.items()}
    has = [Counter(t for k, y in marked.items() if y == v for t in terms[k]) for v in (0, 1)]
    share, known = sum(marked.values()) / len(marked), set(has[0]) | set(has[1])
    spread = Counter(t for c in terms.values() for t in c)
    weight = {t: (np.log((len(texts) + 1) / (spread[t] + 1)) + 1) * abs(np.log((has[1][t] + 4 * share) / (has[0][t] + 4 * (1 - share)) / (share / (1 - share)))) for t in known}

    def vector(c):
        v = {t: (1 + np.log(n)) * weight[t] for t, n in c.items() if t in known}
        size = np.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()} if size else {}

    examples = sorted(((k, vector(terms[k])) for k in marked), key=lambda x: str(x[0]))
    examples = [(k, v) for k, v in examples if v]
    for r in X.score(docs, model).collect():
        q = vector(terms[r["doc_id"]])
        near = sorted(((-round(sum(x * v.get(t, 0) for t, x in q.items()), 12), i) for i, (_, v) in enumerate(examples)))[: model.k]
        near = [(-c, i) for c, i in near if c < 0]
        vote = model.without_terms
        if near:
            w = [1 / (1.05 - min(1.0, c)) for c, _ in near]
            vote = (sum(a * marked[examples[i][0]] for a, (_, i) in zip(w, near)) + model.without_terms) / (sum(w) + 1)
        wanted = float(model.calibration(np.log(np.array([[vote / (1 - vote)]])))[0]) if near else vote
        assert abs(r["score"] - wanted) < 1e-6 and len(r["evidence"]) == min(3, len(near))


def odd_documents(spark):
    rows = [(1, "fine words here"), (2, None), (3, ""), (None, "x"), (1, "fine words here"), (5, "w " * 50_000)]
    return spark.createDataFrame([(k, t, 9, "s", 0.1, "en", None, None) for k, t in rows], "doc_id long, text string, key int, row string, score double, lang string, source string, n_chars long")


def odd_labels(spark, rows=((1, 1, 1), (1, 0, None), (None, 1, 1), (3, None, 0), (5, 1, 0))):
    return spark.createDataFrame([*rows], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("labelled", [True, False])
def test_toxicity_of_odd_rows(spark, labelled):
    docs, labels = odd_documents(spark), odd_labels(spark)
    found = X.score(docs, X.fit(docs, labels if labelled else labels.limit(0))).collect()
    assert len(found) == 6 and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in found)
    assert found[0].__fields__ == ["doc_id", "held_out", "score", "predicted", "evidence"]
    assert X.score(docs.limit(0), X.fit(docs.limit(0), labels)).collect() == []


def test_quality_on_held_out_documents(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    test = F.xxhash64("doc_id") % 3 == 0
    model = Q.fit(docs, labels.where(~test))
    found = Q.score(docs, model).join(labels.where(test), "doc_id").toPandas()
    assert (found.keep == (found.quality == 1)).mean() > 0.95
    kept = Q.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == Q.score(docs, model).where("keep").count()


@pytest.mark.parametrize("rows", [[(1, 1, 0), (3, 0, 1), (1, 0, 0), (None, 1, 0), (5, None, None)], []])
def test_quality_of_odd_rows(spark, rows):
    docs, labels = odd_documents(spark), odd_labels(spark, rows) if rows else odd_labels(spark).limit(0)
    model = Q.fit(docs, labels)
    found = Q.score(docs, model).collect()
    assert len(found) == 6 and all(0 <= r["score"] <= 1 for r in found)
    assert Q.keep_good(docs, model).columns == docs.columns
    assert Q.score(docs.limit(0), model).collect() == []


def test_views_teach_each_other():
    rng = np.random.default_rng(3)
    y = (rng.random(400) < 0.5).astype(float)
    text, metadata = y[:, None] * 4 + rng.normal(size=(400, 1)), y[:, None] * 3 + rng.normal(size=(400, 1))
    truth = (rng.random(3000) < 0.5).astype(float)
    pool = truth[:, None] * 4 + rng.normal(size=(3000, 1)), truth[:, None] * 3 + rng.normal(size=(3000, 1))
    model = Q.co_train(text[:40], metadata[:40], y[:40], *pool)
    joint, a, b = model.scores(text, metadata)
    assert ((joint > 0.5) == (y == 1)).mean() >= max(((a > 0.5) == (y == 1)).mean(), ((b > 0.5) == (y == 1)).mean()) - 0.01
    assert ((joint > 0.5) == (y == 1)).mean() > 0.95


def test_all_unlabelled_documents_take_part(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["good", "words", "here", "!!%", "#*"][: 3 + 2 * (rng.random() < 0.5)]) for _ in range(12)), "en", rng.choice("ab"), i % 90) for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int("!" not in t and "#" not in t)) for i, t, *_ in rows[:300]], "doc_id long, quality int")
    model = Q.fit(docs, labels)
    order = [r[0] for r in docs.orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").select("doc_id").collect()]
    text = np.array([Q.text_features(rows[i][1].encode()) for i in order])
    metadata = np.array([Q.metadata_features(*rows[i][2:]) for i in order])
    known = np.array(order) < 300
    y = np.array([float("!" not in rows[i][1] and "#" not in rows[i][1]) for i in order])[known]
    wanted = Q.co_train(text[known], metadata[known], y, text[~known], metadata[~known])
    for view in ("text", "metadata", "joint"):
        assert np.allclose(getattr(model, view).weights, getattr(wanted, view).weights, atol=1e-6)


def test_logistic_of_one_class():
    assert abs(Logistic.fit(np.zeros((4, 2)), np.ones(4))(np.zeros((1, 2)))[0] - 0.9) < 1e-6


def test_languages_of_documents_and_pages(spark):
    docs, pages = table(spark, "documents"), table(spark, "pages")
    model = L.fit_text(docs)
    found = L.identify(docs.select(F.col("doc_id").alias("id"), F.col("text").alias("body"), F.col("source").alias("url")), model, markup=False)
    right = found.join(docs.select(F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("truth")), "id").agg(F.avg((F.col("lang") == F.col("truth")).cast("int"))).first()[0]
    assert right > 0.98
    found = L.identify(pages.select(F.col("page_id").alias("id"), F.col("html").alias("body"), "url"), model)
    assert found.count() == pages.count()


def test_evidence_decides_where_text_is_silent(spark):
    rng = random.Random(4)
    words = {"de": ["der", "und", "nicht", "schön"], "en": ["the", "and", "with", "this"]}
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words[l]) for _ in range(40)), l) for i in range(60) for l in words], "doc_id long, text string, lang string")
    model = L.fit_text(docs)
    text = {l: " ".join(words[l] * 3) for l in words}
    pages = [(i, f'<html lang="{l}"><p>{text[l]}</p></html>', f"http://{l}.example.{'de' if l == 'de' else 'org'}/{l}/x") for i in range(40) for l in words]
    pages = [(n, *p[1:]) for n, p in enumerate(pages)]
    pages += [(900, '<html lang="de"></html>', "http://de.example.de/de/y"), (901, "", "http://de.example.de/"), (902, None, "http://new.example.de/"), (903, None, None), (904, "<html>", "not an address"), (905, text["en"], "http://[bad")]
    rows = spark.createDataFrame([(str(i), b, u) for i, b, u in pages], "id string, body string, url string")
    found = {r["id"]: r for r in L.identify(rows, model).collect()}
    assert [found[str(i)]["lang"] for i in (900, 901, 902)] == ["de", "de", "de"] and found["905"]["lang"] == "en"
    assert all(0 < r["probability"] <= 1 for r in found.values()) and len(found) == len(pages)
    assert L.identify(rows.limit(0), model).collect() == []
    assert {r["lang"] for r in L.identify(rows, L.fit_text(docs.limit(0))).collect()} == {None}


def test_silent_pages_give_no_vote(spark):
    """The wrong language is the first in order, and most pages of the host are empty."""
    rng = random.Random(8)
    words = {"aa": ["foo", "bar", "quux"], "fr": ["les", "nous", "été", "vous"]}
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words[l]) for _ in range(40)), l) for i in range(60) for l in words], "doc_id long, text string, lang string")
    pages = [(f"e{i}", [None, "", "<p></p>", "1 2 3"][i % 4], "http://x.example/p") for i in range(200)] + [(f"f{i}", " ".join(words["fr"] * 5), "http://x.example/p") for i in range(10)]
    found = {r["id"]: r for r in L.identify(spark.createDataFrame(pages, "id string, body string, url string"), L.fit_text(docs)).collect()}
    assert len(found) == 210 and {r["lang"] for r in found.values()} == {"fr"}
    few = [p for p in pages if p[0] in ("e0", *(f"f{i}" for i in range(10)))]
    one = {r["id"]: r for r in L.identify(spark.createDataFrame(few, "id string, body string, url string"), L.fit_text(docs)).collect()}
    assert found["e0"]["text_lang"] is None and abs(found["e0"]["probability"] - one["e0"]["probability"]) < 1e-12


def test_fusion_like_plain_bayes(spark):
    """Every factor by hand: tempered text, trust in what is declared, host smoothed by domain, suffix and all."""
    rng = random.Random(9)
    words = {"deu": ["der", "und", "nicht"], "en": ["the", "and", "with"], "zh-cn": ["wo", "men", "shi"]}
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words[l]) for _ in range(30)), l) for i in range(40) for l in words], "doc_id long, text string, lang string")
    model = L.fit_text(docs)
    hosts = ["a.x.de", "b.x.de", "c.y.de", "d.z.org"]
    pages = []
    for n in range(90):
        l = rng.choice(list(words))
        tag = rng.choice(["", l, "deu", "zh-CN-hans", "xx"])
        pages.append((str(n), (f'<html lang="{tag}">' if tag else "") + rng.choice(["", " ".join(rng.choices(words[l], k=2))]), f"http://{rng.choice(hosts)}/{rng.choice(['deu', 'q/r', 'zh-cn', 'fr'])}/i"))
    names, known = model.languages, frozenset(model.languages)
    assert names == ["deu", "en", "zh-cn"]
    facts = []
    for _, body, url in pages:
        tag = L._DECLARED.search(body)
        x = model.likelihoods(L.visible_text(body).encode())
        host, domain, suffix, address = L.address_parts(url, known)
        facts.append(({"host": host, "domain": domain, "suffix": suffix, "declared": L.code_of(tag[1], known) if tag else "", "address": address}, x, int(x.argmax()) if x.max() > x.min() else None))
    assert {f[0]["declared"] for f in facts} == {"", "deu", "en", "zh-cn", "xx"} and {f[0]["address"] for f in facts} == {"deu", "zh-cn", "fr", ""}

    def votes(test):
        return np.array([sum(1 for f, _, b in facts if b == i and test(f)) for i in range(3)], float)

    found = {r["id"]: r for r in L.identify(spark.createDataFrame(pages, "id string, body string, url string"), model).collect()}
    for n, (f, x, best) in enumerate(facts):
        own = np.array([float(best == i) for i in range(3)])
        share = votes(lambda g: True) - own + 1
        share /= share.sum()
        for level in (("suffix",), ("domain", "suffix"), ("host", "domain", "suffix")):
            counts = np.maximum(votes(lambda g: all(g[k] == f[k] for k in level)) - own, 0)
            share = (counts + L.SMOOTHING * share) / (counts.sum() + L.SMOOTHING)
        z = x + np.log(share)
        for kind in ("declared", "address"):
            if f[kind]:
                place = lambda v: v if v in names else "other"
                table = np.array([votes(lambda g: g[kind] and place(g[kind]) == v) for v in [*names, "other"]]) + np.vstack([np.full((3, 3), 0.5) + 1.5 * np.eye(3), np.full((1, 3), 0.5)])
                z += np.log(table / table.sum(0))[[*names, "other"].index(place(f[kind]))]
        p = np.exp(z - z.max())
        p /= p.sum()
        r = found[str(n)]
        assert r["lang"] == names[int(p.argmax())] and abs(r["probability"] - p.max()) < 1e-9 and r["text_lang"] == (None if best is None else names[best])


def test_every_language_counts_and_rare_ones_are_sampled(spark):
    rng = random.Random(6)
    names = [a + b for a in "abcdefgh" for b in "klmnopqrs"]
    words = {l: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(8)] for l in names}
    rows = [(l, " ".join(words[l])) for l in names for _ in range(1 if l == "ak" else 2)] + [("bk", " ".join(words["bk"]))] * 400
    docs = spark.createDataFrame([(i, t, l) for i, (l, t) in enumerate(rows)], "doc_id long, text string, lang string")
    model = L.fit_text(docs, sample=40)
    assert model.languages == sorted(names)
    assert {l for l in names if model.languages[int(model.likelihoods(" ".join(words[l]).encode()).argmax())] == l} == set(names)


def test_address_parts():
    assert L.address_parts("https://m.shop.example.co.de:8080/fr/25#top") == ("m.shop.example.co.de", "co.de", "de", "fr")
    assert L.address_parts("http://en.example.org/") == ("en.example.org", "example.org", "org", "en")
    assert L.address_parts(None) == ("", "", "", "") == L.address_parts("http://[bad")


def test_document_frequencies_count_a_term_once_a_document(spark):
    words = [b"alpha", b"alphabet", b"alphabets", b"beta"]
    terms = sorted({X.hash_of(t, 0) for w in words for t in X.terms_of(w)})
    vocabulary = X.Vocabulary(np.array(terms, np.uint64))
    texts = ["alphabet alphabets alphabet beta", "Alpha. alphabets", "", None, "other"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    n, found = X._document_frequencies(docs, vocabulary)
    assert n == len(texts)
    wanted = [0] * len(terms)
    for text in texts:
        for at in vocabulary.counts((text or "").encode())[0]:
            wanted[at] += 1
    assert found.tolist() == wanted and max(wanted) == 2


def test_bounds_in_single_precision_lose_no_neighbour():
    rng = np.random.default_rng(9)
    vectors = []
    for _ in range(700):
        t = np.unique(rng.integers(0, 40, 12))
        w = rng.random(len(t)) * 10.0 ** rng.integers(-9, 1, len(t))
        vectors.append((t, w / np.sqrt(w @ w)))
    index = X.BlockMaxIndex(vectors, 40)
    dense = np.zeros((700, 40))
    for row, (t, w) in zip(dense, vectors):
        row[t] = w
    for t, w in vectors[::35]:
        cosines = np.round(dense[:, t] @ w, 12)
        best = sorted(((-c, i) for i, c in enumerate(cosines.tolist()) if c > 0))[:10]
        got = index.search(t, w, 10)
        assert np.allclose([s for s, _ in got], [-c for c, _ in best], rtol=0, atol=1e-11)
        assert all(abs(cosines[i] - s) <= 1e-11 for s, i in got)
