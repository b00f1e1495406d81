"""Quality classifier by co-training: a text view and a page-metadata view teach each other.

* *Views.* The text view measures the whole text (`text_features`); the metadata
  view sees the language and source (hashed) and the stated length, never the text.
* *Rounds.* Each view is fitted on the labelled sample; of all unlabelled
  documents each gives the documents it is most sure of, up to `GIVE` of each class and
  beyond `SURE` after calibration, as labels to the other view, and both are fitted again.
* *Calibration.* A fifth of the labelled sample is kept apart: on it each view is
  calibrated, and a last fit weighs the two calibrated views, so a view that knows
  nothing about quality weighs next to nothing.
* *Scoring.* All documents are scored in one pass; nothing is shuffled.

Labelled examples are a sample of at most `LABELLED` rows of numbers. The unlabelled documents' features
are written once and scored in tasks in every round; only the rows given as labels come to the driver.
Null text is empty; null metadata is a value of its own. Repeated labels of a document
count once, as bad if any is. Without labels of both classes every score is the smoothed share of
good ones (a half without any).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import pieces, raw
from tidemark.llm.logistic import Logistic, logit, sigmoid
from tidemark.session import durable

LABELLED = 16_384
ROUNDS = 4
GIVE = 400
SURE = 0.98
KEEP = 0.5
_SLOTS = 32

# classes of bytes: 0 small letters, 1 capitals, 2 digits, 3 white space, 4 marks of prose, 5 other ASCII, 6 beyond ASCII
_KINDS = np.array([
    0 if 97 <= c <= 122 else 1 if 65 <= c <= 90 else 2 if 48 <= c <= 57 else 3 if c in b" \t\r\n\f\v" else 4 if c in b".,;:'\"?-()" else 5 if c < 128 else 6
    for c in range(256)], np.uint8)
_OTHERS = b"!*%#&$|<>{}[]/\\=_@+~^"


def text_features(data: bytes) -> list[float]:
    """Shares and lengths that tell prose from noise, all finite, also for an empty text."""
    n = len(data)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256) if n else np.zeros(256, np.int64)
    kinds = np.bincount(_KINDS, weights=counts, minlength=7) / max(1, n)
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    sentences = [x for x in data.replace(b"\n", b" ").split(b". ") if x.strip()]
    m = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    some = counts[counts > 0] / max(1, n)
    return [
        np.log1p(n), *kinds[:7], *[counts[c] / m for c in _OTHERS[:8]], float(lengths.mean()), float(lengths.std()), np.log1p(float(lengths.max())),
        len(set(words)) / m, np.log1p(len(words)), len(set(lines)) / max(1, len(lines)), len(set(sentences)) / max(1, len(sentences)),
        np.log1p(len(words) / max(1, len(sentences))), np.log1p(len(words) / max(1, len(lines))), float(-(some * np.log(some)).sum()),
    ]


TEXT_FEATURES = len(text_features(b""))


def metadata_features(lang: str | None, source: str | None, size: int | None) -> list[float]:
    out = [0.0] * (2 * _SLOTS + 3)
    out[0] = np.log1p(max(0, size or 0))
    out[1] = out[0] ** 2
    out[2] = float(size is None)
    for start, value in ((3, lang), (3 + _SLOTS, source)):
        out[start + (zlib.crc32(value.encode()) % (_SLOTS - 1) if value is not None else _SLOTS - 1)] = 1.0
    return out


@dataclass
class CoTrained:
    text: Logistic
    metadata: Logistic
    text_scale: Logistic
    metadata_scale: Logistic
    joint: Logistic
    share: float | None = None

    def scores(self, text: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The joint score, and each view's calibrated one."""
        if self.share is not None:
            same = np.full(len(text), self.share)
            return same, same, same
        a = self.text_scale.margin(self.text.margin(text)[:, None])
        b = self.metadata_scale.margin(self.metadata.margin(metadata)[:, None])
        return self.joint(np.stack([a, b], 1)), sigmoid(a), sigmoid(b)


#: Of the unlabelled rows not taken, those that a view is most sure of: (view, model, scale, label, taken) to numbers, text and metadata rows.
Pick = Callable[[int, Logistic, Logistic, float, set[int]], tuple[list[int], np.ndarray, np.ndarray]]


def _surest(p: np.ndarray, label: float, free: np.ndarray, give: int, sure: float) -> np.ndarray:
    trust = p if label else 1 - p
    best = np.argsort(-trust, kind="stable")
    return best[(trust[best] >= sure) & free[best]][:give]


def co_train(text: np.ndarray, metadata: np.ndarray, y: np.ndarray, pool_text: np.ndarray, pool_metadata: np.ndarray, rounds: int = ROUNDS, give: int = GIVE, sure: float = SURE) -> CoTrained:
    """Rows must come in random order: every fifth labelled one calibrates."""
    def pick(view: int, model: Logistic, scale: Logistic, label: float, taken: set[int]) -> tuple[list[int], np.ndarray, np.ndarray]:
        p = scale(model.margin((pool_text, pool_metadata)[view])[:, None])
        best = _surest(p, label, np.array([r not in taken for r in range(len(p))], bool), give, sure)
        return best.tolist(), pool_text[best], pool_metadata[best]

    return _exchange(text, metadata, y, pick, rounds)


def _exchange(text: np.ndarray, metadata: np.ndarray, y: np.ndarray, pick: Pick, rounds: int = ROUNDS) -> CoTrained:
    apart = np.arange(len(y)) % 5 == 0
    if not len(y) or y.min() == y.max() or len(set(y[apart])) < 2 or len(set(y[~apart])) < 2:
        none = Logistic.fit(np.zeros((0, 1)), np.zeros(0))
        return CoTrained(none, none, none, none, none, float((y.sum() + 1) / (len(y) + 2)))
    views = [text, metadata]
    learned = [[(x[~apart], y[~apart])] for x in views]
    taken: list[set[int]] = [set(), set()]  # rows whose pseudo-labels each view has got
    for turn in range(rounds + 1):
        models = [Logistic.fit(np.concatenate([x for x, _ in parts]), np.concatenate([z for _, z in parts])) for parts in learned]
        scales = [Logistic.fit(m.margin(x[apart])[:, None], y[apart]) for m, x in zip(models, views, strict=True)]
        if turn == rounds:
            break
        before = len(taken[0]) + len(taken[1])
        for i in (0, 1):
            for label, (rows, *found) in [(label, pick(i, models[i], scales[i], label, taken[1 - i])) for label in (1.0, 0.0)]:
                taken[1 - i].update(rows)
                learned[1 - i].append((found[1 - i], np.full(len(rows), label)))
        if len(taken[0]) + len(taken[1]) == before:
            break
    both = np.stack([s.margin(m.margin(x[apart])[:, None]) for m, s, x in zip(models, scales, views, strict=True)], 1)
    return CoTrained(*models, *scales, Logistic.fit(both, y[apart]))


def _frame(documents: DataFrame, key: str, text: str) -> DataFrame:
    def column(name: str, kind: str) -> F.Column:
        return (F.col(f"`{name}`") if name in documents.columns else F.lit(None)).cast(kind).alias(name)

    return documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"), column("lang", "string"), column("source", "string"), column("n_chars", "long"))


def _features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    text = np.array([text_features(t) for t in raw(batch.column("text"))]).reshape(-1, TEXT_FEATURES)
    metadata = np.array([metadata_features(*r) for r in zip(*[batch.column(c).to_pylist() for c in ("lang", "source", "n_chars")], strict=True)])
    return text, metadata.reshape(len(text), -1)


def _matrices(rows: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Both views of rows with measured texts (column a)."""
    values = [x.flatten().to_numpy() for x in (rows.column("a").chunks if isinstance(rows, pa.Table) else [rows.column("a")])]
    text = np.concatenate([np.zeros(0), *values]).reshape(-1, TEXT_FEATURES)
    metadata = np.array([metadata_features(*r) for r in zip(*[rows.column(c).to_pylist() for c in ("lang", "source", "n_chars")], strict=True)], np.float64)
    return text, metadata.reshape(len(text), 2 * _SLOTS + 3)


def fit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", labelled: int = LABELLED, give: int = GIVE, sure: float = SURE) -> CoTrained:
    """Fit on the labelled documents of least hash, at most `labelled`, and all unlabelled ones."""
    docs = _frame(documents, key, text).where("key is not null")
    marked = labels.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("key")).agg(F.min((F.col(f"`{label}`") > 0).cast("int")).alias("y"))
    chosen = marked.orderBy(F.xxhash64("key"), "key").limit(labelled)
    kind = docs.schema["key"].dataType

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = pa.array([text_features(t) for t in raw(batch.column("text"))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("key", "lang", "source", "n_chars")], found], names=["key", "lang", "source", "n_chars", "a"])

    measured = durable(docs.mapInArrow(measure, T.StructType([T.StructField("key", kind), *T._parse_datatype_string("lang string, source string, n_chars long, a array<double>").fields])), "features")
    rows = measured.join(F.broadcast(chosen), "key").orderBy(F.xxhash64("key", F.lit(1)), "key", "a").limit(labelled).select("y", "lang", "source", "n_chars", "a").toArrow()
    pool = durable(measured.join(marked.select("key"), "key", "left_anti").withColumn("id", F.monotonically_increasing_id()), "unlabelled")

    names = pool.columns

    def pick(view: int, model: Logistic, scale: Logistic, label: float, taken: set[int]) -> tuple[list[int], np.ndarray, np.ndarray]:
        def surest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                p = scale(model.margin(_matrices(batch)[view])[:, None])
                free = np.array([i not in taken for i in batch.column("id").to_pylist()], bool)
                # no cut inside the batch: which of equals are taken is decided over all rows
                best = _surest(p, label, free, len(p), sure)
                trust = pa.array((p if label else 1 - p)[best], pa.float64())
                yield pa.RecordBatch.from_arrays([*[batch.column(c).take(pa.array(best)) for c in names], trust], names=[*names, "trust"])

        schema = T.StructType([*pool.schema.fields, T.StructField("trust", T.DoubleType())])
        best = pool.mapInArrow(surest, schema).orderBy(F.desc("trust"), F.xxhash64("key", F.lit(1)), "key", "a", "id").limit(give).toArrow()
        return best.column("id").to_pylist(), *_matrices(best)

    return _exchange(*_matrices(rows), rows.column("y").to_numpy().astype(np.float64), pick)


def score(documents: DataFrame, model: CoTrained, key: str = "doc_id", text: str = "text", keep: float = KEEP) -> DataFrame:
    """Per row: the key, score, text_score, metadata_score, keep."""
    frame = _frame(documents, key, text)
    schema = T.StructType([T.StructField("key", frame.schema["key"].dataType), *T._parse_datatype_string("score double, text_score double, metadata_score double, keep boolean").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            joint, a, b = model.scores(*_features(batch))
            yield pa.RecordBatch.from_arrays([batch.column("key"), *[pa.array(x, pa.float64()) for x in (joint, a, b)], pa.array(joint >= keep, pa.bool_())], names=["key", "score", "text_score", "metadata_score", "keep"])

    return frame.mapInArrow(run, schema).withColumnRenamed("key", key)


def keep_good(documents: DataFrame, model: CoTrained, text: str = "text", keep: float = KEEP) -> DataFrame:
    """The rows that score at least `keep`, with all their columns."""
    meta = _frame(documents.withColumn("__key", F.lit(0)), "__key", text)
    others = [c for c in documents.columns if c != text]
    frame = documents.select(
        F.struct(F.lit(0).alias("__one"), *[F.col(f"`{c}`") for c in others]).alias("row"), F.col(f"`{text}`").cast("string").alias("text"),
        *[(F.col(f"`{c}`").cast(meta.schema[c].dataType) if c in documents.columns else F.lit(None).cast(meta.schema[c].dataType)).alias(c) for c in ("lang", "source", "n_chars")])
    schema = T.StructType([frame.schema["row"], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            good = pa.array(model.scores(*_features(batch))[0] >= keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("text")], names=["row", "text"]).filter(good)

    out = frame.mapInArrow(run, schema)
    return out.select(*[F.col("text").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in documents.columns])
