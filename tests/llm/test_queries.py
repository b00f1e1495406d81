"""The registered queries over the smallest tables, against the libraries and brute force."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def encoded(docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return {k: e.ids for (k, _), e in zip(docs, tokenizer.encode_batch([t for _, t in docs], add_special_tokens=False))}


def run(spark, name):
    return entry.queries()[name](spark, FOLDER)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing(spark, encoded):
    found = run(spark, "op1_packing").toPandas()
    for key, g in found.groupby("doc_id"):
        ids, at = [*encoded[key], 2], 0
        for r in g.sort_values("start").itertuples():
            assert r.start == at and crc(ids[at : at + r.length]) == r.ids_crc32 and r.doc_tokens == len(ids)
            at += r.length
        assert at == len(ids)
    assert set(found.doc_id) == set(encoded)


def test_suffix_dedup(spark, docs):
    found = {r[0]: [tuple(r)[1:]] for r in run(spark, "op2_suffix_dedup").collect()}
    assert found == brute.repeats(docs, 400)


def test_decontamination(spark, docs):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert sorted(map(tuple, run(spark, "op5_decontamination").collect()), key=str) == brute.contamination(docs, items, 10)


def test_token_files(spark, encoded):
    start, wanted = 0, []
    for k in sorted(encoded):
        ids = [*encoded[k], 1]
        wanted.append((k, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, run(spark, "op6_token_files").collect())) == wanted


def test_token_counts(spark, docs):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    wanted = sorted((k, len(t.encode()), len(ids), len(ids) > 4096) for (k, t), ids in zip(docs, model.encode([t for _, t in docs])))
    assert sorted(map(tuple, run(spark, "op9_token_counts").collect())) == wanted


def test_jaccard_join(spark, docs):
    assert sorted(map(tuple, run(spark, "op10_jaccard_join").collect()), key=str) == brute.jaccard_classes(docs)


@pytest.mark.parametrize("name", ["op3_language_id", "op7_toxicity", "op8_quality"])
def test_every_document_has_a_row(spark, docs, name):
    found = [r["doc_id"] for r in run(spark, name).collect() if r["doc_id"] is not None]
    assert sorted(found) == sorted(k for k, _ in docs)


def test_nearest_neighbours(spark):
    found = run(spark, "op4_nearest_neighbours").toPandas()
    ids = {r["vec_id"] for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()}
    assert set(found.query_id) == {i for i in ids if i % 50 == 0} and (found.groupby("query_id").size() == 5).all()
