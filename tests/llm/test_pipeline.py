"""Each stage on the smallest tables: what it is given, what it decides, what it returns."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
from tests.llm import brute
from tidemark.llm import quality
from tidemark.session import scratch_path

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for _, stage in C.STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, out[-1], FOLDER).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_columns_stay(stages):
    assert all(df.columns == stages[0].columns for df in stages[:5])


def test_quality(spark, stages):
    model = quality.fit(stages[0], spark.read.parquet(f"{FOLDER}/labels.parquet"))
    good = {r["doc_id"] for r in quality.score(stages[0], model).where("keep").collect()}
    assert {k for k, _ in rows(stages[1])} == good


def test_one_of_each_class_stays(stages):
    classes = {c for _, c, _, _ in brute.jaccard_classes(rows(stages[1]))}
    assert sorted(k for k, _ in rows(stages[2])) == sorted(classes)


def test_repeated_passages_go(stages):
    before = rows(stages[2])
    removed = {k: v[0][1] for k, v in brute.repeats(before, C.REPEAT_BYTES).items()}
    after = dict(rows(stages[3]))
    for k, text in before:
        lost = len(text.encode()) - len(after[k].encode())
        assert removed[k] <= lost <= removed[k] + 12  # and the rest of characters cut in part
    assert all(r["n_chars"] == len(r["text"]) for r in stages[3].collect())


def test_benchmark_windows_go(spark, stages):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    hits = {r[0]: r for r in brute.contamination(rows(stages[3]), items, 10)}
    for k, text in rows(stages[4]):
        assert len(brute.words(text)) == hits[k][1] - hits[k][2]


def test_packing_holds_every_token(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = {k: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for k, t in rows(stages[4])}
    packed = stages[5].toPandas()
    assert packed.groupby("doc_id").length.sum().to_dict() == sizes
    assert packed.groupby("sequence_id").length.sum().max() <= 4096


def test_run_is_the_stages_in_turn(spark, stages):
    found = C.run(spark, FOLDER)
    key = ["doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert sorted(map(tuple, found.select(*key).collect())) == sorted(map(tuple, stages[5].select(*key).collect()))
