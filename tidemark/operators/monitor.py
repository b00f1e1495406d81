"""Column profiles. Every statistic is a distributed aggregation over the whole frame."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalar import prefixed_id
from tidemark.functions.transforms import row_positions, standard_scale
from tidemark.model import FeatureGroup

PAIRS = 400  # pairs of columns that one aggregation correlates
TOP = 50


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _number(column: str) -> Column:
    """The column as a double; NaN counts as missing."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _finite(column: str) -> Column:
    """The same without infinities, which have no place in means, bins and scores."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def _long(df: DataFrame, columns: Sequence[str], as_type: str) -> DataFrame:
    """(name, value) pairs of several columns."""
    typed = df.select(*[F.col(c).cast(as_type).alias(c) for c in columns])
    return typed.unpivot([], list(columns), "name", "value")


def _prepared(df: DataFrame, columns: Sequence[str], *kept: str) -> DataFrame:
    """Each column as v0, v1, … and its finite values as f0, f1, …: computed once a row, however many aggregates use them."""
    df = df.select(*kept, *[_number(c).alias(f"v{i}") for i, c in enumerate(columns)])
    return df.select("*", *[F.when(F.abs(f"v{i}") < float("inf"), F.col(f"v{i}")).alias(f"f{i}") for i in range(len(columns))])


def _basic(i: int) -> dict[str, Column]:
    return {
        "value_count": F.count(f"v{i}"),
        "missing_count": F.count(F.lit(1)) - F.count(f"v{i}"),
        "minimum": F.min(f"v{i}"),
        "maximum": F.max(f"v{i}"),
        "mean": F.avg(f"f{i}"),
        "standard_deviation": F.stddev_samp(f"f{i}"),
    }


def profile_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, missing, minimum, maximum, mean and deviation of each numeric column, in one pass.

    NaN counts as missing; mean and deviation are those of the finite values.
    """
    columns = list(columns or numeric_columns(df))
    rows = [F.struct(F.lit(c).alias("name"), *[v.alias(s) for s, v in _basic(i).items()]) for i, c in enumerate(columns)]
    return _prepared(df, columns).agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each value of each column occurs; counted before the shuffle.

    Columns of one type are counted together, and only distinct values become text.
    """
    return _frequencies(df, columns).drop("number")


def _frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same with the values of numeric columns as doubles too."""
    by_type: dict[T.DataType, list[str]] = {}
    for c in columns:
        by_type.setdefault(df.schema[c].dataType, []).append(c)
    out = None
    for dtype, names in by_type.items():
        counts = _long(df, names, dtype.simpleString()).where("value IS NOT NULL").groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
        number = F.col("value").cast("double") if isinstance(dtype, T.NumericType) else F.lit(None).cast("double")
        part = counts.select("name", F.col("value").cast("string").alias("value"), number.alias("number"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def profile_entropy(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values and entropy, -sum(p ln p), of each column."""
    return _entropy(frequencies(df, columns))


def _entropy(counts: DataFrame) -> DataFrame:
    total, weighted = F.sum("n"), F.sum(F.col("n") * F.log("n"))
    return counts.groupBy("name").agg(
        F.count(F.lit(1)).alias("distinct_count"), (F.log(total) - weighted / total).alias("entropy")
    )


def profile_topk(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """The k most common values of each column; equal counts in order of value."""
    return _topk(frequencies(df, columns), k)


def _topk(counts: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("name").orderBy(F.col("n").desc(), F.col("value").asc())
    ranked = counts.withColumn("position", F.row_number().over(w))
    return ranked.where(F.col("position") <= k).select("name", "value", "n", "position")


@dataclass(frozen=True)
class Spread:
    """Range and moments of one column."""

    low: float
    high: float
    mean: float
    deviation: float


def spreads(df: DataFrame, columns: Sequence[str]) -> dict[str, Spread]:
    """Range, mean and population deviation of the columns that hold finite values, of those values, in one pass."""
    measures = (F.min, F.max, F.avg, F.stddev_pop)
    row = df.agg(*[m(_finite(c)) for c in columns for m in measures]).first()
    found = {c: row[4 * i : 4 * i + 4] for i, c in enumerate(columns)}
    return {c: Spread(*values) for c, values in found.items() if values[0] is not None}


def profile_histogram(
    df: DataFrame, columns: Sequence[str], bins: int = 10, spread: dict[str, Spread] | None = None
) -> DataFrame:
    """Counts of finite values in bins of equal width; the highest bin includes the maximum."""
    return _counted(df, _steps(spread or spreads(df, columns), bins, _finite), "bin")


def profile_zscore(df: DataFrame, columns: Sequence[str], spread: dict[str, Spread] | None = None) -> DataFrame:
    """Row counts by whole standard deviations from the mean, -4 and 4 holding all beyond."""
    return _counted(df, _deviations(spread or spreads(df, columns), _finite), "deviations")


def _steps(spread: dict[str, Spread], bins: int, value: Callable[[str], Column]) -> dict[str, Column]:
    number = {}
    for c, s in spread.items():
        width = (s.high - s.low) / bins or 1.0
        number[c] = F.least(F.floor((value(c) - F.lit(s.low)) / F.lit(width)), F.lit(bins - 1).cast("long"))
    return number


def _deviations(spread: dict[str, Spread], value: Callable[[str], Column]) -> dict[str, Column]:
    return {
        c: F.greatest(F.least(F.floor(score), F.lit(4).cast("long")), F.lit(-4).cast("long"))
        for c, score in _scores(spread, value).items()
    }


def _scores(spread: dict[str, Spread], value: Callable[[str], Column]) -> dict[str, Column]:
    return {c: (value(c) - F.lit(s.mean)) / F.lit(s.deviation or 1.0) for c, s in spread.items()}


def _counted(df: DataFrame, number: dict[str, Column], output: str) -> DataFrame:
    # least and greatest skip nulls, so missing values are kept out by hand.
    bins = [F.when(_finite(c).isNotNull(), n).alias(c) for c, n in number.items()]
    long = df.select(*bins).unpivot([], list(number), "name", output)
    return long.where(F.col(output).isNotNull()).groupBy("name", output).agg(F.count(F.lit(1)).alias("n"))


def profile_correlation(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Correlation of each pair of columns, by default of all numeric ones, over rows where both are finite.

    One aggregation takes up to 400 pairs; more pairs take more of them.
    """
    columns = list(columns or numeric_columns(df))
    pairs = list(combinations(columns, 2))
    out = None
    for i in range(0, max(1, len(pairs)), PAIRS):
        rows = [
            F.struct(F.lit(a).alias("name"), F.lit(b).alias("other"), F.corr(_finite(a), _finite(b)).alias("correlation"))
            for a, b in pairs[i : i + PAIRS]
        ]
        if not rows:
            return df.sparkSession.createDataFrame([], "name string, other string, correlation double")
        part = df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
        out = part if out is None else out.unionByName(part)
    return out


def profile(df: DataFrame, columns: Sequence[str] | None = None, top: int = TOP, bins: int = 10) -> DataFrame:
    """One row per column with all statistics, as a report stores them.

    Two scans: the first for counts and moments, one row that the bins need at
    once; the second for the distinct values, from which everything else is counted.
    """
    numeric = list(columns or numeric_columns(df))
    ranges = {"low": F.min, "high": F.max, "centre": F.avg, "deviation": F.stddev_pop}
    row = _prepared(df, numeric).agg(*[
        F.struct(*[v.alias(s) for s, v in _basic(i).items()], *[m(f"f{i}").alias(s) for s, m in ranges.items()]).alias(f"c{i}")
        for i in range(len(numeric))]).first()
    spread = {c: Spread(r["low"], r["high"], r["centre"], r["deviation"]) for c, r in zip(numeric, row) if r["low"] is not None}
    basic = df.sparkSession.createDataFrame(
        [(c, *[r[s] for s in _basic(0)]) for c, r in zip(numeric, row)],
        "name string, size long, missingValuesCount long, min double, max double, mean double, standardDeviation double")
    # The conditions on n are always true: they keep filters above the counts, so that every use shares one shuffle.
    counts = _frequencies(df, numeric).where("n > 0")
    parts = [
        _entropy(counts).withColumnRenamed("distinct_count", "distinctValuesCount"),
        _gather(_topk(counts, top), ["position", "value", "n"], "mostCommonValues"),
        _gather(_bins(counts, _steps(spread, bins, _of), "bin"), ["bin", "n"], "valueDistribution"),
        _gather(_bins(counts, _deviations(spread, _of), "deviations"), ["deviations", "n"], "zScoreDistribution"),
        *_extremes(counts, top),
        _outliers(counts, spread, top),
    ]
    # Every part has one row per column, so the parts are laid over each other.
    united = basic
    for part in parts:
        united = united.unionByName(part, allowMissingColumns=True)
    return united.groupBy("name").agg(*[F.max(c).alias(c) for c in united.columns if c != "name"])


def _of(name: str) -> Column:
    """The finite value of a row of counts, for rows of one column."""
    return F.when((F.col("name") == name) & ~F.isnan("number") & (F.abs("number") < float("inf")), F.col("number"))


def _bins(counts: DataFrame, number: dict[str, Column], output: str) -> DataFrame:
    """Rows by the number of their value, from counts of values."""
    placed = F.coalesce(*[F.when(_of(c).isNotNull(), n) for c, n in number.items()]) if number else F.lit(None).cast("long")
    return counts.select("name", "n", F.when(F.col("n") > 0, placed).alias(output)).where(F.col(output).isNotNull()).groupBy("name", output).agg(F.sum("n").alias("n"))


def _gather(df: DataFrame, fields: list[str], output: str) -> DataFrame:
    """A short list per column: at most ``top`` or ``bins`` entries."""
    return df.groupBy("name").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias(output))


def _extremes(counts: DataFrame, k: int) -> list[DataFrame]:
    values = counts.select("name", F.col("number").alias("value"))
    orders = {"minimumValues": F.col("value").asc(), "maximumValues": F.col("value").desc()}
    return [_first_k(values, order, k, output) for output, order in orders.items()]


def _outliers(counts: DataFrame, spread: dict[str, Spread], k: int) -> DataFrame:
    """The k scores furthest out, a value as often as it occurs."""
    scores = _scores(spread, _of)
    score = F.coalesce(*scores.values()) if scores else F.lit(None).cast("double")
    far = counts.select("name", "n", F.when(F.col("n") > 0, score).alias("value")).where(F.abs("value") > 3)
    far = far.select("name", F.explode(F.array_repeat("value", F.least(F.col("n"), F.lit(k)).cast("int"))).alias("value"))
    return _first_k(far, F.abs("value").desc(), k, "zScoreOutliersSample")


def _first_k(values: DataFrame, order: Column, k: int, output: str) -> DataFrame:
    ranked = values.withColumn("r", F.row_number().over(Window.partitionBy("name").orderBy(order)))
    return ranked.where(F.col("r") <= k).groupBy("name").agg(F.sort_array(F.collect_list("value")).alias(output))


def drift_rows(
    df: DataFrame, fg: FeatureGroup, record_count: int, feature: str, prefix: str = "O", n: int | None = 1000
) -> DataFrame:
    """The first n rows under new ids, with one feature standardised, to be ingested as drift.

    New ids continue from the number of records; ``n=None`` takes every row.
    """
    # The hash orders rows of one record, so that the sort can cut a large record.
    order = [F.col(fg.record_id).asc(), F.xxhash64(*df.columns).asc()]
    numbered = row_positions(df if n is None else df.orderBy(*order).limit(n), order, "__position")
    scaled = standard_scale(numbered, feature)
    new_id = prefixed_id(prefix, F.col("__position") + F.lit(record_count))
    return scaled.withColumn(fg.record_id, new_id).drop("__position")
