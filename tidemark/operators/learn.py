"""Training sets, exact splits, training and batch scoring."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.model import SYSTEM_COLUMNS

SPLITS = ("train", "validation", "test")
ROUNDS = 100  # fixed value: boosting rounds
BINS = 32  # fixed value: bins of a feature, as many as the trees look at by default
REORDER_THRESHOLD, DISCOUNT_THRESHOLD = 0.5, 0.65  # fixed values

_PREFIX_STEP = 4  # hex digits per refinement: 65,536 counts reach the driver at most
_FETCH = 10_000
_HASH_DIGITS = 32


def training_set(joined: DataFrame, label: str, drop: Sequence[str]) -> DataFrame:
    """Label first, then features: ids, times, system and leaking columns go, repeated names too."""
    gone = {*drop, *SYSTEM_COLUMNS}
    kept = [c for c in joined.columns if re.sub(r"_\d+$", "", c) not in gone and c not in gone]
    return joined.select(label, *[c for c in kept if c != label])


def split_key(id_column: str, seed: int) -> Column:
    return F.md5(F.concat_ws("-", F.col(id_column).cast("string"), F.lit(seed).cast("string")))


def split(
    df: DataFrame, id_column: str, seed: int = 123, cuts: Sequence[float] = (0.7, 0.9), names: Sequence[str] = SPLITS
) -> DataFrame:
    """Shuffle split with exact sizes: the first int(0.7 n) rows by hashed id, and so on.

    Rows are not sorted or moved. The hash values at the cuts are found from
    counts per hash prefix, and each row compares its own hash with them. Rows
    of one id stay together.
    """
    keys = df.select(split_key(id_column, seed).alias("key"))
    counts = _prefix_counts(keys, "")
    total = sum(n for _, n in counts)
    bounds = _keys_at(keys, counts, [int(cut * total) for cut in cuts])
    key, out = split_key(id_column, seed), F.lit(names[-1])
    for bound, name in reversed(list(zip(bounds, names))):
        inside = F.lit(True) if bound is None else key < F.lit(bound)
        out = F.when(inside, name).otherwise(out)
    return df.withColumn("split", out)


def _prefix_counts(keys: DataFrame, prefix: str) -> list[tuple[str, int]]:
    here = keys.where(F.col("key").startswith(prefix)) if prefix else keys
    part = F.substring("key", 1, len(prefix) + _PREFIX_STEP).alias("prefix")
    rows = here.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()
    return sorted((r["prefix"], r["n"]) for r in rows)


def _keys_at(keys: DataFrame, counts: list[tuple[str, int]], positions: list[int]) -> list[str | None]:
    """The hashes at 0-based positions of the sorted order; None past the end.

    A prefix with few rows is fetched, one with many is counted by longer prefixes.
    """
    places = [_locate(keys, counts, position) for position in positions]
    prefixes = sorted({p[0] for p in places if p is not None and len(p[0]) < _HASH_DIGITS})
    found: dict[str, list[str]] = {p: [] for p in prefixes}
    if prefixes:
        wanted = functools.reduce(Column.__or__, [F.col("key").startswith(p) for p in prefixes])
        for row in keys.where(wanted).collect():
            for p in prefixes:
                if row["key"].startswith(p):
                    found[p].append(row["key"])
    ranked = {p: sorted(ks) for p, ks in found.items()}
    return [None if at is None else ranked[at[0]][at[1]] if at[0] in ranked else at[0] for at in places]


def _locate(keys: DataFrame, counts: list[tuple[str, int]], position: int) -> tuple[str, int] | None:
    """A prefix of at most ``_FETCH`` rows and the position inside it."""
    while True:
        for prefix, n in counts:
            if position < n:
                break
            position -= n
        else:
            return None
        if n <= _FETCH or len(prefix) >= _HASH_DIGITS:
            return prefix, position
        counts = _prefix_counts(keys, prefix)


def train_classifier(
    df: DataFrame, label: str, features: Sequence[str], rounds: int = ROUNDS, seed: int = 123
) -> PipelineModel:
    """Gradient-boosted trees for a 0/1 label; missing feature values count as zero.

    Trees see a feature in at most 32 bins: its values, or 32nds of all rows where it has more. Rows
    alike in all bins are counted once and trained on as one row of that weight, so the rounds pass
    over the combinations that occur and not over the rows.
    """
    filled = df.fillna(0, list(features))
    binned = [f"__bin{i}" for i in range(len(features))]
    numbers = ", ".join(f"cast(`{f}` as double) as __number{i}" for i, f in enumerate(features))
    cast = SQLTransformer(statement=f"select *, {numbers} from __THIS__")
    raw = [f"__number{i}" for i in range(len(features))]
    bins = Bucketizer(inputCols=raw, outputCols=binned, splitsArray=_bin_edges(cast.transform(filled), raw))
    # A sum is a plain number; the bins themselves are marked as categories, whose order trees ignore.
    numbered = ", ".join(f"{b} + 0e0 as __feature{i}" for i, b in enumerate(binned))
    ordered = SQLTransformer(statement=f"select *, {numbered} from __THIS__")
    inputs = [f"__feature{i}" for i in range(len(features))]
    rows = ordered.transform(bins.transform(cast.transform(filled)))
    counted = rows.groupBy(label, *inputs).agg(F.count(F.lit(1)).cast("double").alias("__weight"))
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    trees = GBTClassifier(labelCol=label, featuresCol="features", weightCol="__weight", maxIter=rounds, maxBins=BINS, seed=seed)
    learned = Pipeline(stages=[assembler, trees]).fit(counted)
    return PipelineModel([cast, bins, ordered, *learned.stages])


def _bin_edges(df: DataFrame, columns: Sequence[str]) -> list[list[float]]:
    """Edges of each column's bins: midway between its values if they are few, otherwise at its quantiles."""
    at = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    found = df.agg(*[F.approx_count_distinct(c).alias(f"n{c}") for c in columns], *[F.percentile_approx(c, at, 10_000).alias(c) for c in columns]).first()
    few = [c for c in columns if found[f"n{c}"] <= 2 * BINS]  # the count is approximate
    values = df.agg(*[F.collect_set(c).alias(c) for c in few]).first() if few else {}
    edges = []
    for c in columns:
        known = sorted(values[c]) if c in few else []
        if c in few and len(known) <= BINS:
            inner = [(a + b) / 2 for a, b in zip(known, known[1:])]
        else:
            inner = sorted(set(found[c] or []))
        edges.append([float("-inf"), *(inner or [0.0]), float("inf")])
    return edges


def score(model: PipelineModel, df: DataFrame, features: Sequence[str], output: str = "prediction_score") -> DataFrame:
    """Input rows with the probability of the positive class beside them."""
    scored = model.transform(df.fillna(0, list(features)))
    return scored.withColumn(output, vector_to_array("probability")[1]).select(*df.columns, output)


def score_foreign(
    df: DataFrame,
    load: Callable[[], Any],
    predict: Callable[[Any, pd.DataFrame], Sequence[float]],
    skip: int = 2,
    output: str = "prediction_score",
) -> DataFrame:
    """Score with a model from elsewhere, loaded once per task; the first ``skip`` columns are not features."""
    columns = df.columns[skip:]

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for batch in batches:
            yield batch.assign(**{output: predict(model, batch[columns])})

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), f"`{output}` double"])
    return df.mapInPandas(apply, schema)


def decide(
    df: DataFrame, score_column: str, threshold: float, negative: str, positive: str, output: str = "decision"
) -> DataFrame:
    """Below the threshold is negative, at or above it positive."""
    return df.withColumn(output, F.when(F.col(score_column) < threshold, negative).otherwise(positive))
