"""Feature transforms. Fitting is one aggregation; applying it is a projection.

Fitted values on the driver are single numbers per column. Encodings of columns
with many distinct values stay distributed tables.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalar import days_since
from tidemark.operators.select import sanitize_names
from tidemark.session import durable

INFERRED = ("bigint", "double", "timestamp")

# Age bins and their labels.
AGE_EDGES = (18, 30, 40, 50, 60, 70, 90)
AGE_LABELS = ("18-29", "30-39", "40-49", "50-59", "60-69", "70-plus")


def row_positions(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Exact positions 0, 1, … in a total order, without gathering the rows in one task.

    The frame is range-sorted and written to the shared folder, so that its
    partitions are fixed; each row adds its place in the partition to the number
    of rows in the partitions before it.
    """
    spark = df.sparkSession
    ranged = df.orderBy(*order).withColumn("__m", F.monotonically_increasing_id())
    ranged = ranged.withColumn("__p", F.shiftright("__m", 33))
    fixed = durable(ranged, "positions")
    sizes = fixed.groupBy("__p").agg(F.count(F.lit(1)).alias("size"), F.min("__m").alias("first")).orderBy("__p")
    offsets, before = [], 0
    for row in sizes.collect():  # one row per sort partition
        offsets.append((row["__p"], before - row["first"]))
        before += row["size"]
    table = spark.createDataFrame(offsets, "__p long, __offset long")
    placed = fixed.withColumn("__p", F.col("__p").cast("long")).join(F.broadcast(table), "__p")
    return placed.withColumn(name, F.col("__m") + F.col("__offset")).drop("__m", "__p", "__offset")


def dictionary(df: DataFrame, columns: Sequence[str] | Mapping[str, str], order: str = "freq") -> DataFrame:
    """name, label, label_index, n: the values of several columns with their index, by frequency or by alphabet.

    One scan whatever the number of columns: they are laid under each other,
    counted once, and ranked within their column by one range sort, from which
    the number of labels before each column is subtracted. A mapping gives each column an order of its own.
    """
    orders = dict(columns) if isinstance(columns, Mapping) else dict.fromkeys(columns, order)
    if wrong := [o for o in orders.values() if o not in ("freq", "alpha")]:
        raise ValueError(f"order must be 'freq' or 'alpha', not {wrong[0]!r}")
    names = list(orders)
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in names]).unpivot([], names, "name", "label")
    counts = texts.where("label IS NOT NULL").groupBy("name", "label").agg(F.count(F.lit(1)).alias("n"))
    by_count = [c for c, o in orders.items() if o == "freq"]
    first = [F.when(F.col("name").isin(by_count), -F.col("n")).otherwise(0).asc()] if by_count else []
    ranked = row_positions(counts, [F.col("name").asc(), *first, F.col("label").asc()], "__place")
    starts = ranked.groupBy("name").agg(F.min("__place").alias("__start"))  # one row to a column
    return ranked.join(F.broadcast(starts), "name").select("name", "label", (F.col("__place") - F.col("__start")).alias("label_index"), "n")


def ordinal_labels(df: DataFrame, column: str, order: str = "freq") -> DataFrame:
    """Distinct values of a column with their index, by frequency or by alphabet."""
    return dictionary(df, [column], order).select("label", "label_index")


def encode_many(df: DataFrame, columns: Sequence[str] | Mapping[str, str], order: str = "freq", vectors: bool = False) -> DataFrame:
    """Replace several columns by the index of their values; null stays null.

    All columns are fitted together (`dictionary`). With `vectors` each becomes a
    sparse 0/1 vector of `pyspark.ml.linalg` instead, as long as the column has values; null is all
    zero. Columns may have any number of values: the dictionary is joined, not listed.
    """
    if not columns:
        return df
    labels = durable(dictionary(df, columns, order), "dictionary")
    sizes = {r["name"]: r["n"] for r in labels.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()} if vectors else {}
    out = df
    for c in columns:
        one = labels.where(F.col("name") == c).select(F.col("label").alias("__label"), F.col("label_index").alias("__index"))
        out = out.join(one, F.col(c).cast("string") == F.col("__label"), "left")
        out = out.select(*[F.col("__index").alias(k) if k == c else F.col(k) for k in df.columns])
    return _as_vectors(out, {c: sizes.get(c, 0) for c in columns}) if vectors else out


def _as_vectors(df: DataFrame, sizes: Mapping[str, int]) -> DataFrame:
    """Indices as sparse vectors of known sizes. The size goes along as metadata, so nothing is scanned for it."""
    from pyspark.ml.feature import OneHotEncoder

    # an index beyond the last stands for null; it is "kept" as one more place, which dropLast leaves out
    known = {c: F.coalesce(F.col(c).cast("double"), F.lit(float(max(n, 1)))) for c, n in sizes.items()}
    meta = {c: {"ml_attr": {"type": "nominal", "num_vals": max(n, 1)}} for c, n in sizes.items()}
    indexed = df.select(*[F.col(c) for c in df.columns], *[v.alias(f"__{c}", metadata=meta[c]) for c, v in known.items()])
    encoder = OneHotEncoder(inputCols=[f"__{c}" for c in sizes], outputCols=[f"__vector_{c}" for c in sizes], handleInvalid="keep", dropLast=True)
    made = encoder.fit(indexed).transform(indexed)
    return made.select(*[F.col(f"__vector_{c}").alias(c) if c in sizes else F.col(c) for c in df.columns])


def ordinal_encode(df: DataFrame, column: str, order: str = "freq", output: str | None = None) -> DataFrame:
    """Replace a column by the index of its value; null stays null.

    'freq' gives 0 to the most frequent value (equal counts in alphabetical
    order), 'alpha' gives 0 to the first in the alphabet. They can disagree.
    """
    output = output or column
    labels = ordinal_labels(df, column, order).withColumnRenamed("label_index", "__index")
    joined = df.join(labels, F.col(column).cast("string") == F.col("label"), "left")
    columns = [F.col("__index").alias(output) if c == output else F.col(c) for c in df.columns]
    if output not in df.columns:
        columns.append(F.col("__index").alias(output))
    return joined.select(*columns)


def minmax(
    df: DataFrame, columns: str | Sequence[str], decimals: int | None = 2, constant: float = 0.5
) -> DataFrame:
    """Scale columns to 0..1 in place; a constant column becomes ``constant``."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    return minmax_of(df, df, columns, decimals, constant)


def minmax_of(
    fitted: DataFrame, df: DataFrame, columns: Sequence[str], decimals: int | None = 2, constant: float = 0.5
) -> DataFrame:
    """Scale ``df`` by bounds taken from ``fitted``, which may be an earlier, cheaper plan."""
    bounds = fitted.agg(*[f(F.col(c).cast("double")) for c in columns for f in (F.min, F.max)]).first()
    return df.withColumns(
        {
            c: _scaled(F.col(c).cast("double"), bounds[2 * i], bounds[2 * i + 1], decimals, constant)
            for i, c in enumerate(columns)
        }
    )


def standard_scale(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Centre and divide by the population deviation; a constant column is only centred."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    moments = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    scaled = {}
    for i, c in enumerate(columns):
        mean, deviation = moments[f"m{i}"], moments[f"s{i}"] or 1.0
        scaled[c] = (F.col(c).cast("double") - F.lit(mean).cast("double")) / F.lit(deviation)
    return df.withColumns(scaled)


def bucketize(
    df: DataFrame,
    column: str,
    edges: Sequence[float] = AGE_EDGES,
    labels: Sequence[str] = AGE_LABELS,
    output: str | None = None,
) -> DataFrame:
    """Label right-closed bins, the lowest edge included; outside the edges is null."""
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per bin is needed")
    value, out = F.col(column), None
    for i, label in enumerate(labels):
        above = value >= edges[i] if i == 0 else value > edges[i]
        inside = above & (value <= edges[i + 1])
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return df.withColumn(output or column, out)


def categories(df: DataFrame, column: str) -> list:
    """Distinct values in order: they become columns, so they are listed on the driver. `encode_many` lists none."""
    return sorted(r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().collect())


def one_hot(
    df: DataFrame, column: str, prefix: str, values: Sequence | None = None, keep: bool = False
) -> DataFrame:
    """One 0/1 column per category, named ``prefix_value`` without spaces; null is all zero."""
    values = categories(df, column) if values is None else values
    flags = [
        F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{prefix}_{v}") for v in values
    ]
    base = [c for c in df.columns if keep or c != column]
    return sanitize_names(df.select(*base, *flags))


def one_hot_sparse(df: DataFrame, column: str, output: str) -> DataFrame:
    """The category of any column as a sparse 0/1 vector: its size and the place of the one, counted from 0.

    Places follow the alphabet; null has none. There is no limit on categories,
    as no column is made for each.
    """
    labels = durable(ordinal_labels(df, column, "alpha"), "labels")
    joined = df.join(labels, F.col(column).cast("string") == labels["label"], "left")
    vector = F.struct(F.lit(labels.count()).cast("long").alias("size"), F.col("label_index").alias("place"))
    return joined.select(*[c for c in df.columns if c != output], vector.alias(output))


def bool_to_int(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    columns = [columns] if isinstance(columns, str) else columns
    return df.withColumns({c: F.col(c).cast("int") for c in columns})


def days_since_scaled(
    df: DataFrame, column: str, output: str, as_of: date | str, decimals: int | None = 2, constant: float = 0.5
) -> DataFrame:
    """Days from a date column to ``as_of``, scaled to 0..1; the date column is dropped."""
    aged = df.withColumn(output, days_since(F.col(column), as_of)).drop(column)
    return minmax(aged, output, decimals, constant)


def pandas_transform(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str
) -> DataFrame:
    """A user's pandas function on Arrow batches.

    A batch is part of the data, so the function must treat rows one by one;
    statistics over the whole column belong to the transforms above.
    """

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(apply, schema)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns; a value that does not fit becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def infer_types(df: DataFrame) -> dict[str, str]:
    """Narrowest of bigint, double, timestamp, string that every value of a text column fits."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    # A few rows rule out most types; the whole frame then tests one type per column at a time.
    open_types = {c: list(INFERRED) for c in text}
    for c, types in _fitting(df.limit(1000), [(c, t) for c in text for t in INFERRED], empty=True).items():
        open_types[c] = types
    found: dict[str, str] = {}
    while tests := [(c, types[0]) for c, types in open_types.items() if types and c not in found]:
        fitting = _fitting(df, tests, empty=False)
        for c, t in tests:
            if c in fitting:
                found[c] = t
            else:
                open_types[c] = open_types[c][1:]
    return {c: found.get(c, "string") for c in text}


def _fitting(df: DataFrame, tests: list[tuple[str, str]], empty: bool) -> dict[str, list[str]]:
    """The tested types that every value of a column casts to; ``empty`` says if none at all do."""
    counts = df.agg(
        *[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(f"{c} misses {t}") for c, t in tests],
        *[F.count(c).alias(f"{c} values") for c in dict.fromkeys(c for c, _ in tests)],
    ).first()
    out: dict[str, list[str]] = {c: [] for c, _ in tests} if empty else {}
    for c, t in tests:
        if counts[f"{c} misses {t}"] == 0 and (empty or counts[f"{c} values"] > 0):
            out.setdefault(c, []).append(t)
    return out


def infer_and_cast(df: DataFrame) -> DataFrame:
    return cast_columns(df, infer_types(df))


def run_flow(df: DataFrame, steps: Iterable[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    return functools.reduce(DataFrame.transform, steps, df)


def prepare_orders(
    df: DataFrame,
    as_of: date | str,
    amount: str = "purchase_amount",
    flag: str = "is_reordered",
    purchased: str = "purchased_on",
) -> DataFrame:
    """Encode the flag by frequency, scale the amount and the days since the purchase."""
    aged = df.withColumn("n_days_since_last_purchase", days_since(F.col(purchased), as_of)).drop(purchased)
    encoded = ordinal_encode(aged, flag, "freq")
    encoded = encoded.withColumn(flag, F.col(flag).cast("int"))
    return minmax_of(aged, encoded, [amount, "n_days_since_last_purchase"])


def _scaled(value: Column, low: float | None, high: float | None, decimals: int | None, constant: float) -> Column:
    if low is None:
        return F.lit(None).cast("double")
    if low == high:
        out = F.when(value.isNotNull(), F.lit(float(constant)))
    else:
        out = (value - F.lit(low)) / F.lit(high - low)
    return out if decimals is None else F.round(out, decimals)


def prepare_customers(
    df: DataFrame,
    as_of: date | str,
    drop: Sequence[str] = ("name", "state"),
    age: str = "age",
    encode: Sequence[str] = ("sex", "is_married"),
    active_since: str = "active_since",
) -> DataFrame:
    """Bin and one-hot the age, encode flags by alphabet, scale the days active."""
    out = df.drop(*drop)
    out = bucketize(out, age, output="age_range").drop(age)
    out = one_hot(out, "age_range", "age", AGE_LABELS)
    out = encode_many(out, [c for c in encode if c in out.columns], "alpha")
    days = df.select(days_since(F.col(active_since), as_of).alias("n_days_active"))
    out = out.withColumn("n_days_active", days_since(F.col(active_since), as_of)).drop(active_since)
    return minmax_of(days, out, ["n_days_active"], decimals=None, constant=0.0)


def prepare_products(
    df: DataFrame, drop: Sequence[str] = ("product_name",), category: str = "product_category"
) -> DataFrame:
    return one_hot(df.drop(*drop), category, "category")
