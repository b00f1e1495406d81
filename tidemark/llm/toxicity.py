"""Toxicity by nearest labelled examples: exact TF-IDF cosine through a block-max inverted index.

* *Examples.* At most `EXAMPLES` labelled documents, those of least hash; rows
  whose crc32(doc_id) mod 5 is 0 are never among them.
* *Terms.* All words of the examples and the first five letters of longer ones. A term
  weighs its inverse document frequency, from all documents, times the smoothed log odds
  of the label where it occurs (`_leaning`), so that words which go with a label decide
  which texts are near. No term is left out, however rare it is or however small the table.
* *Index.* Examples in blocks of `BLOCK`. Postings of rare terms are added up in full. Of common terms (in over
  `COMMON` of the examples) each block keeps the greatest weight, and each example the length of its
  common part; an example's bound is its sum over rare terms plus the lesser of the query's weights times the block's greatest
  ones and the product of both lengths. Examples are opened by falling bound until no other can
  reach the k-th best, so the k nearest are exact.
* *Score.* Votes of the k nearest, weighted by closeness, are calibrated by a
  logistic fit on the examples themselves, each without its own vote. Texts that share no
  word with any example get the smoothed share of toxic ones among such examples.

Documents are read for frequencies and for scores, and the sample's for terms and vectors; they aren't shuffled. Terms
are known by 64-bit hashes (others are tried if two terms of the examples share one); a word outside the examples could share one
too, about once in 10^13 words. What goes to the tasks is bounded by the examples and their words. Null text is empty.
Repeated labels of a document count once, as toxic if any is. Null labels don't count. Without
labels all scores are the same low prior.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import pieces, raw, table
from tidemark.llm.decontaminate import split_words
from tidemark.llm.logistic import Logistic, logit
from tidemark.session import durable

EXAMPLES = 16_384
#: Examples without any lean that a term's odds are smoothed by.
SMOOTHING = 4.0
NEAREST = 25
BLOCK = 16
PREFIX = 5
#: Share of the examples above which a term's postings are opened only where its greatest weights ask for it.
COMMON = 1 / 32
#: By how much a bound may miss a cosine that it equals.
_SLACK = 1e-11
#: More than what sums of single precision can fall short by.
_ROUNDED = 1.001
_MEMORY = 400_000


def terms_of(word: bytes) -> list[bytes]:
    return [word, b"^" + word[:PREFIX]] if len(word) > PREFIX else [word]


@dataclass
class Vocabulary:
    """Terms as sorted 64-bit hashes, known to be of different terms, and their weights; with a bounded memory of words."""

    hashes: np.ndarray
    seed: int = 0
    idf: np.ndarray | None = None
    memory: dict[bytes, int] = field(default_factory=dict)
    numbers: np.ndarray | None = None

    def places(self, words: Collection[bytes]) -> np.ndarray:
        """The numbers of each word's terms, -1 where there is none."""
        at_words = list(map(self.memory.get, words))
        if None not in at_words:
            return self.numbers[at_words]
        new = [w for w, at in zip(words, at_words, strict=True) if at is None]
        if len(self.memory) + len(new) > _MEMORY:
            self.memory.clear()
            new = list(words)
        at = len(self.memory)
        if self.numbers is None or at + len(new) > len(self.numbers):
            more = np.full((2 * at + len(new) + 1024, 2), -1)
            if at:
                more[:at] = self.numbers[:at]
            self.numbers = more
        terms = [terms_of(w) for w in new]
        owner = np.repeat(np.arange(at, at + len(new)), [len(ts) for ts in terms])
        h = np.array([hash_of(t, self.seed) for ts in terms for t in ts], np.uint64)
        place = np.searchsorted(self.hashes, h)
        known = place < len(self.hashes)
        known[known] = self.hashes[place[known]] == h[known]
        which = np.concatenate([[0], np.diff(owner) == 0]).astype(np.int64)
        self.numbers[at : at + len(new)] = -1
        self.numbers[owner, which] = np.where(known, place, -1)
        self.memory.update(zip(new, range(at, at + len(new)), strict=True))
        return self.numbers[[self.memory[w] for w in words]]

    def counts(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Terms in order and how often each occurs."""
        words = Counter(split_words(text))
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        numbers = self.places(words.keys()).ravel()
        known = numbers >= 0
        times = np.repeat(np.fromiter(words.values(), np.int64, len(words)), 2)[known]
        order = np.argsort(numbers[known])
        terms, times = numbers[known][order], times[order]
        first = np.flatnonzero(np.diff(terms, prepend=-1))
        return terms[first], np.add.reduceat(times, first) if len(first) else times

    def measured(self, text: bytes) -> tuple[np.ndarray, np.ndarray, float]:
        """Terms in order, how often each occurs, and the length of their vector."""
        terms, times = self.counts(text)
        weights = weigh(times, self.idf[terms], 1.0)
        size = float(np.sqrt(weights @ weights))
        return (terms, times, size) if size else (terms[:0], times[:0], 1.0)

    def vector(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Terms in order and their weights, of unit length."""
        terms, times, size = self.measured(text)
        return terms, weigh(times, self.idf[terms], size)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memory": {}, "numbers": None}


def weigh(times: np.ndarray, idf: np.ndarray, size: np.ndarray | float) -> np.ndarray:
    return (1 + np.log(times.astype(np.float64))) * idf / size


def hash_of(term: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(term, seed)


def _mark(terms: np.ndarray, weights: np.ndarray) -> bytes:
    return hashlib.blake2b(terms.astype(np.int32).tobytes() + weights.tobytes(), digest_size=16).digest()


def _runs(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each run, n of them."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - first, n)


class BlockMaxIndex:
    """Exact cosine search over unit vectors of positive weights."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int, block: int = BLOCK, measured: tuple[list[float], list[int]] | None = None) -> None:
        """With `measured`, the vectors' lengths and leading terms, `vectors` say how often terms occur; the weights come by `weigh_by`, where they are needed."""
        # examples led by one term stand together, so bounds are tight
        lead = measured[1] if measured else [int(t[np.argmax(w)]) for t, w in vectors]
        self.order = np.array(sorted(range(len(vectors)), key=lambda i: (lead[i], len(vectors[i][0]), i)), np.int64)
        self.block, self.blocks, self.terms = block, -(-len(vectors) // block), terms
        rows = np.repeat(np.arange(len(vectors), dtype=np.int32), [len(vectors[i][0]) for i in self.order])
        term = np.concatenate([vectors[i][0] for i in self.order], dtype=np.int32, casting="same_kind") if vectors else np.zeros(0, np.int32)
        by_term = np.argsort(term, kind="stable").astype(np.int32)  # rows stay in order
        self.rows, self.term = rows[by_term], term[by_term]
        del rows, term
        self.weights = self.times = self.sizes = None
        held = np.concatenate([vectors[i][1] for i in self.order]) if vectors else np.zeros(0)
        if measured and vectors:
            self.times = held.astype(np.min_scalar_type(held.max(initial=1)))[by_term]
            self.sizes = np.array([measured[0][i] for i in self.order])
        else:
            self.weights = held[by_term]
        self.column: np.ndarray | None = None

    def weigh_by(self, idf: np.ndarray) -> None:
        """The weights anew, to the last bit, where they didn't travel."""
        if self.weights is None:
            self.weights = weigh(self.times, idf[self.term], self.sizes[self.rows])

    def __getstate__(self) -> dict:
        """Postings alone, in the narrowest form: rows as small numbers, and where each term's end."""
        ends = np.searchsorted(self.term, np.arange(self.terms), side="right").astype(np.int32)
        rows = self.rows.astype(np.min_scalar_type(max(1, len(self.order))))
        return {"order": self.order, "block": self.block, "blocks": self.blocks, "terms": self.terms, "rows": rows, "ends": ends, "weights": self.weights if self.times is None else None, "times": self.times, "sizes": self.sizes}

    def __setstate__(self, state: dict) -> None:
        ends = state.pop("ends")
        self.__dict__ = state | {"rows": state["rows"].astype(np.int32), "term": np.repeat(np.arange(len(ends), dtype=np.int32), np.diff(ends, prepend=0)), "column": None}

    def _open(self) -> None:
        """Part the terms. Each process does so itself, as the parts are larger than the postings."""
        n, starts = len(self.order), np.searchsorted(self.term, np.arange(self.terms + 1))
        self.starts, frequency = starts[:-1], np.diff(starts)
        common = np.flatnonzero(frequency > max(self.block, n * COMMON))
        self.column = np.full(self.terms, -1)
        self.column[common] = np.arange(len(common))
        self.rare = np.where(self.column < 0, frequency, 0)
        p = np.flatnonzero(self.column[self.term] >= 0)
        p = p[np.argsort(self.rows[p], kind="stable")]
        rows, self.columns, self.held = self.rows[p], self.column[self.term[p]], self.weights[p]
        self.begin = np.searchsorted(rows, np.arange(n + 1))
        self.lengths = np.sqrt(np.bincount(rows, self.held**2, self.blocks * self.block)).reshape(self.blocks, self.block)
        most = np.zeros((len(common), self.blocks))
        np.maximum.at(most, (self.columns, rows // self.block), self.held)
        self.most = np.nextafter(most.astype(np.float32), np.float32(np.inf))  # never less

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The k nearest as (cosine, example), best first, equal ones by number of the example; without cosines of 0."""
        if self.column is None:
            self._open()
        n, rare = len(self.order), self.rare[terms]
        postings = _runs(self.starts[terms], rare)
        held = self.weights.take(postings)
        held *= np.repeat(weights, rare)
        sums = np.bincount(self.rows.take(postings), held, n)
        column = self.column[terms]
        some = column >= 0
        wanted = np.zeros(len(self.most))
        wanted[column[some]] = weights[some]
        in_block = (weights[some].astype(np.float32) @ self.most.take(column[some], 0)) * _ROUNDED
        bounds = np.minimum(in_block[:, None], np.sqrt(weights[some] @ weights[some]) * self.lengths).ravel()[:n]
        bounds += sums

        # the best by rare terms give a cosine that the others have to reach
        ahead = np.argpartition(-sums, k)[:k] if n > k else np.arange(n)
        scores, found = self._nearest(self._exact(ahead, sums, wanted), ahead, k)
        bounds[ahead] = 0
        left = np.flatnonzero(bounds >= scores[k - 1] - _SLACK if len(scores) >= k else bounds > 0)
        left = left[bounds[left] > 0]
        left = left[np.argsort(-bounds[left], kind="stable")]
        at, step = 0, 4 * k
        while at < len(left) and not (len(scores) >= k and bounds[left[at]] < scores[k - 1] - _SLACK):
            rows = left[at : at + step]
            scores, found = self._nearest(np.concatenate([scores, self._exact(rows, sums, wanted)]), np.concatenate([found, rows]), k)
            at, step = at + step, 2 * step
        return list(zip(scores.tolist(), self.order[found].tolist(), strict=True))

    def _exact(self, rows: np.ndarray, sums: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        n = self.begin[rows + 1] - self.begin[rows]
        p = _runs(self.begin[rows], n)
        held = self.held.take(p)
        held *= wanted.take(self.columns.take(p))
        common = np.bincount(np.repeat(np.arange(len(rows)), n), held, len(rows))
        return np.round(sums[rows] + common, 12)

    def _nearest(self, scores: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        best = np.lexsort((self.order[rows], -scores))[:k]
        best = best[scores[best] > 0]
        return scores[best], rows[best]


@dataclass
class Model:
    vocabulary: Vocabulary
    index: BlockMaxIndex | None
    labels: np.ndarray
    keys: list
    without_terms: float
    calibration: Logistic | None
    k: int
    known: dict = field(default_factory=dict)
    shared: tuple[Broadcast, Broadcast] | None = None

    def opened(self) -> Model:
        """In a task: vocabulary and index as the process has them, loaded once for all its tasks."""
        if self.shared is not None and self.index is None:
            self.vocabulary, self.index = (part.value for part in self.shared)
            self.index.weigh_by(self.vocabulary.idf)
        return self

    def votes(self, near: list[tuple[float, int]]) -> float:
        if not near:
            return self.without_terms
        w = np.array([1 / (1.05 - min(1.0, s)) for s, _ in near])
        y = np.array([self.labels[i] for _, i in near])
        return float((w @ y + self.without_terms) / (w.sum() + 1))

    def score(self, text: bytes) -> tuple[float, list]:
        """The score and the keys of the three nearest examples."""
        terms, weights = self.vocabulary.vector(text)
        if not len(terms) or not len(self.labels):
            return self.without_terms, []
        mark = _mark(terms, weights)
        if mark not in self.known:
            near = self.index.search(terms, weights, self.k)
            raw_vote = self.votes(near)
            score = float(self.calibration(logit(np.array([[raw_vote]])))[0]) if self.calibration else raw_vote
            if len(self.known) > 50_000:
                self.known.clear()
            self.known[mark] = (score, [self.keys[i] for _, i in near[:3]])
        return self.known[mark]

    def __getstate__(self) -> dict:
        away = {} if self.shared is None else {"vocabulary": None, "index": None}
        return self.__dict__ | {"known": {}} | away


def held_out(key: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", examples: int = EXAMPLES, k: int = NEAREST) -> Model:
    """Learn terms, index and calibration from a bounded sample of the labels that aren't held out."""
    docs = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    marked = labels.where(~held_out(key) & F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("key")).agg(F.max((F.col(f"`{label}`") > 0).cast("int")).alias("y"))
    chosen = marked.orderBy(F.xxhash64("key"), "key").limit(examples)
    sample = docs.join(F.broadcast(chosen), "key")  # at most `examples` rows of numbers
    vocabulary, leaning = _leaning(sample)
    n, frequency = _document_frequencies(docs, vocabulary)
    vocabulary.idf = (np.log((n + 1) / (frequency + 1)) + 1) * leaning
    del frequency, leaning
    context = docs.sparkSession.sparkContext
    words = context.broadcast(vocabulary)  # bounded by the examples, as the index is; each is sent once for all jobs

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = [words.value.measured(t) for t in raw(batch.column("text"))]
            weights = [weigh(n, words.value.idf[t], size) for t, n, size in found]
            columns = [pa.array([t for t, _, _ in found], pa.list_(pa.int32())), pa.array([n for _, n, _ in found], pa.list_(pa.int32())), pa.array([x for _, _, x in found], pa.float64()), pa.array([_mark(t, w) for (t, _, _), w in zip(found, weights, strict=True)], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("y"), *columns], names=["key", "y", "terms", "times", "size", "mark"])

    schema = T.StructType([T.StructField("key", docs.schema["key"].dataType), *T._parse_datatype_string("y int, terms array<int>, times array<int>, size double, mark binary").fields])
    written = durable(sample.select("key", "y", "text").mapInArrow(vectors, schema), "examples")  # read here and by the tasks below
    rows = written.toArrow()
    keys, y = rows.column("key").to_pylist(), rows.column("y").to_pylist()
    numbers, times = ([x.values.to_numpy() for x in rows.column(c)] for c in ("terms", "times"))
    sizes, marks = rows.column("size").to_pylist(), rows.column("mark").to_pylist()
    order = sorted(range(len(keys)), key=lambda i: (str(keys[i]), marks[i]))
    plain = [y[i] for i in order if not len(numbers[i])]
    used = [i for i in order if len(numbers[i])]
    share = sum(y) / len(y) if y else 0.1
    without = (sum(plain) + share) / (len(plain) + 1)
    lead = [int(numbers[i][np.argmax(weigh(times[i], vocabulary.idf[numbers[i]], sizes[i]))]) for i in used]
    index = BlockMaxIndex([(numbers[i], times[i]) for i in used], max(1, len(vocabulary.hashes)), measured=([sizes[i] for i in used], lead))
    del rows, numbers, times
    sent = context.broadcast(index)
    del index
    model = Model(vocabulary, None, np.array([y[i] for i in used], np.float64), [keys[i] for i in used], without, None, k, shared=(words, sent))
    if used:
        votes = _votes_of_others(written, model, {marks[i]: at for at, i in reversed(list(enumerate(used)))})
        own = np.array([votes[marks[i], y[i]] for i in used])
        model.calibration = Logistic.fit(logit(own[:, None]), model.labels)
    return model


def _votes_of_others(examples: DataFrame, model: Model, place: dict[bytes, int]) -> dict[tuple[bytes, int], float]:
    """By vector and label, the votes of an example's nearest others. One example of its own vector and label is left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model.opened()
        for batch in batches:
            out: dict[tuple[bytes, int], float] = {}
            for y, mark, terms, times, size in zip(*(batch.column(c).to_pylist() for c in ("y", "mark")), batch.column("terms"), batch.column("times"), batch.column("size").to_pylist(), strict=True):
                if mark in place and (mark, y) not in out:
                    terms = terms.values.to_numpy()
                    weights = weigh(times.values.to_numpy(), model.vocabulary.idf[terms], size)
                    near = model.index.search(terms, weights, model.k + 1)
                    own = next((i for s, i in near if model.labels[i] == y and s > 1 - 1e-9), place[mark])
                    out[mark, y] = model.votes([x for x in near if x[1] != own][: model.k])
            yield pa.RecordBatch.from_arrays([pa.array([m for m, _ in out], pa.binary()), pa.array([y for _, y in out], pa.int32()), pa.array(list(out.values()), pa.float64())], names=["mark", "y", "vote"])

    rows = examples.select("y", "mark", "terms", "times", "size").mapInArrow(run, "mark binary, y int, vote double").collect()  # at most `examples`
    return {(bytes(r["mark"]), r["y"]): r["vote"] for r in rows}


def _leaning(sample: DataFrame) -> tuple[Vocabulary, np.ndarray]:
    """All terms of the examples, and how far each term's smoothed odds of the label are from those of all."""
    totals = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    if not clean or not toxic:
        return Vocabulary(np.zeros(0, np.uint64)), np.zeros(0)
    for seed in range(8):
        def count(batches: Iterator[pa.RecordBatch], seed: int = seed) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, "text"):
                found: dict[bytes, list[int]] = {}
                for y, text in zip(batch.column("y").to_pylist(), raw(batch.column("text")), strict=True):
                    for term in {t for w in set(split_words(text)) for t in terms_of(w)}:
                        found.setdefault(term, [0, 0])[y] += 1
                hashes = [np.array([hash_of(t, s) for t in found], np.uint64).view(np.int64) for s in (seed, seed + 1000)]
                yield table(pa.schema([(n, pa.int64()) for n in ("hash", "other", "clean", "toxic")]), {"hash": hashes[0], "other": hashes[1], "clean": [v[0] for v in found.values()], "toxic": [v[1] for v in found.values()]})

        counted = sample.select("y", "text").mapInArrow(count, "hash long, other long, clean long, toxic long").groupBy("hash").agg(
            F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"), (F.min("other") != F.max("other")).alias("mixed")).toArrow()
        if not any(c.true_count for c in counted.column("mixed").chunks):  # else two terms share a hash: try others
            break
    hashes = counted.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    a, b = (counted.column(c).to_numpy()[order].astype(np.float64) for c in ("toxic", "clean"))
    share = toxic / (clean + toxic)
    odds = np.log((a + SMOOTHING * share) / (b + SMOOTHING * (1 - share)) / (share / (1 - share)))
    return Vocabulary(hashes[order], seed), np.abs(odds)


def _document_frequencies(docs: DataFrame, vocabulary: Vocabulary) -> tuple[int, np.ndarray]:
    """Of all documents: how many, and how many have each term."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary.hashes) + 1, np.int64)
        for batch in pieces(batches, "text"):
            for text in raw(batch.column("text")):
                total[-1] += 1
                words = set(split_words(text))
                if words:
                    numbers = vocabulary.places(words)
                    total[numbers[numbers >= 0]] += 1  # once for each term, however many words have it
        some = np.flatnonzero(total)
        yield table(pa.schema([("term", pa.int64()), ("n", pa.int64())]), {"term": some, "n": total[some]})

    out = np.zeros(len(vocabulary.hashes) + 1, np.int64)
    found = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out[found.column("term").to_numpy()] = found.column("n").to_numpy()
    return int(out[-1]), out[:-1]


def score(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, held_out, score, predicted, evidence (the nearest examples' keys)."""
    frame = documents.select(F.col(f"`{key}`").alias("key"), held_out(key).alias("held_out"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = frame.schema["key"].dataType
    schema = T.StructType([T.StructField("key", kind), *T._parse_datatype_string("held_out boolean, score double, predicted int").fields, T.StructField("evidence", T.ArrayType(kind))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model.opened()
        for batch in pieces(batches, "text"):
            found = [model.score(t) for t in raw(batch.column("text"))]
            key_type = batch.schema.field("key").type
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("held_out"), pa.array([s for s, _ in found], pa.float64()), pa.array([int(s >= 0.5) for s, _ in found], pa.int32()), pa.array([e for _, e in found], pa.list_(key_type))],
                names=["key", "held_out", "score", "predicted", "evidence"])

    return frame.mapInArrow(run, schema).withColumnRenamed("key", key)
