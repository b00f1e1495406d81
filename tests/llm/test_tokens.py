"""Encoding, token counts, token files and packing against the libraries themselves."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm.encoding import WordEncoder
from tidemark.llm.idfiles import PerfectHash, Shard, key_hashes, read_ids, write_ids
from tidemark.llm.packing import LevelArray, pack
from tidemark.llm.token_counts import Counter, counts_only, token_counts

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SIGNS = [*"aAbB'st, .!é́Σσİ<|>endoftext   \x1c\x85\n\t1²١中\x00", "<|endoftext|>", "'s ", "'LL", "<|startoftext|>", " ́", "<|ENDOFTEXT|>", "</s>", "▁", "  "]
ODD = [(1, "one two"), (2, None), (3, ""), (4, "word " * 9000), (1, "one two"), (None, "x"), (None, None), (5, "<|endoftext|> it's"), (6, "a" * 5000)]
SCHEMA = "doc_id long, text string, key string, tokens int, n_tokens int, start int"


def frame(spark, rows=ODD):
    """A table with columns that operators use as names of their own."""
    return spark.createDataFrame([(k, t, "clash", -1, -2, -3) for k, t in rows], SCHEMA)


def noise(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(30))) for _ in range(n)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_gives_the_ids_of_the_library(name):
    path = public_tokenizers.path(name)
    encoder, tokenizer = WordEncoder(path, cache_chunks=50), Tokenizer.from_file(path)
    texts = [*noise(1, 3000), "", "The Quick, brown!! fox\n" * 50, "Größe naïve ÀÉ"]
    for i in range(0, len(texts), 500):
        part = texts[i : i + 500]
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(part)]
        assert got == [e.ids for e in tokenizer.encode_batch(part, add_special_tokens=False)]


def test_long_texts_split_at_safe_places_only():
    counter, model = Counter(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert counter.splits
    for text in [*noise(2, 300), "two  spaces ▁ and ▁x " * 40, "no-space" * 100]:
        parts = counter.parts(text, 5)
        assert sum(len(model.encode(p)) for p in parts) == len(model.encode(text))


def test_counts(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    wanted = sorted(((k, len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 4096) for k, t in ODD), key=str)
    assert sorted(map(tuple, counts_only(frame(spark), PIECES).collect()), key=str) == wanted
    full = token_counts(frame(spark), PIECES)
    assert full.columns == ["doc_id", "text", "key", "tokens", "start", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, full.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()), key=str) == wanted
    assert counts_only(frame(spark, []), PIECES).collect() == []


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 5000, dtype=np.uint64))
    found = PerfectHash.build(keys)
    assert sorted(found.lookup(keys).tolist()) == list(range(len(keys)))
    assert len(found.bits) * 8 < 4.5 * len(keys)
    assert PerfectHash.build(keys[:0]).lookup(keys[:3]).tolist() == [-1] * 3
    assert len(set(map(tuple, np.stack(key_hashes([1, "1", None, 1], [0, 0, 0, 1])).T.tolist()))) == 4


def expected_ids(rows, end):
    tokenizer = Tokenizer.from_file(WORDS)
    return [(k, [*tokenizer.encode(t or "", add_special_tokens=False).ids, end]) for k, t in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_files_round_trip(spark, tmp_path):
    folder = f"file://{tmp_path}/ids"
    manifest = write_ids(frame(spark), folder, WORDS, shards=3)
    got = sorted(map(tuple, read_ids(frame(spark), folder, manifest).collect()), key=lambda r: r[1])
    start, wanted = 0, []
    for k, ids in sorted(expected_ids(ODD, 1), key=lambda r: (r[0] is not None, r[0] or 0, len(r[1]))):
        wanted.append((k, start, len(ids), crc(ids)))
        start += len(ids)
    assert got == wanted
    first = manifest.collect()[0]
    shard = Shard(folder, first["shard"])
    assert shard.find([12345, first["first"]])[0] is None and shard.find([first["first"]])[0] is not None
    assert read_ids(spark.createDataFrame([(999,)], "doc_id long"), folder, manifest).collect() == []
    empty = write_ids(frame(spark, []), f"{folder}-none", WORDS, shards=2)
    assert read_ids(frame(spark, []), f"{folder}-none", empty).collect() == []


def test_level_array_takes_the_least_sum_of_squares():
    rng = random.Random(4)
    for window in (5, 12):
        levels, fills = LevelArray(window), {}
        for _ in range(400):
            size = rng.randrange(1, window)
            counts = [0] * (window + 1)
            for f in fills.values():
                if f < window:
                    counts[f] += 1

            def squares(level):
                after = list(counts)
                if level:
                    after[level] -= 1
                if level + size < window:
                    after[level + size] += 1
                return sum(c * c for c in after)

            choices = [h for h in range(window - size + 1) if h == 0 or counts[h]]
            which, offset = levels.place(size)
            assert offset == fills.get(which, 0)
            assert squares(offset) == min(map(squares, choices))
            assert offset == max(h for h in choices if squares(h) == squares(offset))
            fills[which] = offset + size


def test_packing(spark):
    rng = random.Random(5)
    rows = [*ODD, *((i, "w " * rng.randrange(9000)) for i in range(10, 60))]
    got = pack(frame(spark, rows), WORDS, shard_docs=20).toPandas()
    rebuilt = []
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g.offset.values == np.concatenate([[0], np.cumsum(g.length.values)[:-1]])).all() and g.length.sum() <= 4096
    for key, ids in expected_ids(rows, 2):
        same = got[got.doc_id.isna() if key is None else got.doc_id == key]
        same = same[same.doc_tokens == len(ids)]
        for i in range(0, len(ids), 4096):
            part = ids[i : i + 4096]
            assert ((same.start == i) & (same.length == len(part)) & (same.ids_crc32 == crc(part))).any()
        rebuilt.append(-(-len(ids) // 4096))
    assert len(got) == sum(rebuilt)
    assert pack(frame(spark, []), WORDS).collect() == []
