"""Column choices, history lookups, simple counts and unions of feature groups."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.model import API_TIME, IS_DELETED, WRITE_TIME, FeatureGroup, feature_names
from tidemark.operators.latest import as_time, by_ids


def select_features(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    return df if names is None else df.select(*names)


def without_features(df: DataFrame, groups: Sequence[FeatureGroup], exclude: Sequence[str]) -> DataFrame:
    """The features of several groups, in group order, minus an exclusion list."""
    wanted = dict.fromkeys(n for _, n in feature_names(groups, exclude) if n in df.columns)
    return df.select(*wanted)


def drop_deleted(df: DataFrame) -> DataFrame:
    """Live rows; a null marker counts as neither live nor deleted and is dropped."""
    return df.where(~F.col(IS_DELETED))


def where_present(df: DataFrame, feature: str) -> DataFrame:
    return df.where(F.col(feature).isNotNull())


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def label_first(df: DataFrame, label: str) -> DataFrame:
    return df.select(label, *[c for c in df.columns if c != label])


def sanitize_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: c.replace(" ", "_") for c in df.columns if " " in c})


def historical(
    history: DataFrame,
    fg: FeatureGroup,
    ids: DataFrame | Sequence | None = None,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """All versions, optionally of some record ids and with some columns."""
    return select_features(by_ids(history, fg.record_id, ids), names)


def get_record(current: DataFrame, fg: FeatureGroup, record_id: Any, names: Sequence[str] | None = None) -> DataFrame:
    """The record of one id: no row when it is absent."""
    return select_features(current.where(F.col(fg.record_id) == F.lit(record_id)), names)


def query(frames: Mapping[str, DataFrame], sql: str) -> DataFrame:
    """Run SQL that names feature groups; the views last only while the query is analysed.

    Two groups whose names give one view, and a view or table of the session
    that already has the name, are refused rather than hidden.
    """
    spark = next(iter(frames.values())).sparkSession
    names = [view_name(name) for name in frames]
    if clash := {n for n in names if names.count(n) > 1 or spark.catalog.tableExists(n)}:
        raise ValueError(f"these names are taken: {sorted(clash)}")
    try:
        for name, df in zip(names, frames.values(), strict=True):
            df.createTempView(name)
        return spark.sql(sql)
    finally:
        for name in names:
            spark.catalog.dropTempView(name)


def view_name(group: str) -> str:
    return group.replace("-", "_")


def sql_transform(df: DataFrame, group: str, query_fn: Callable[[str], str]) -> DataFrame:
    """Apply a user's SQL to the frame, seen as a view that only this call knows; the function gets its name."""
    name = f"{view_name(group)}_{uuid.uuid4().hex}"
    df.createTempView(name)
    try:
        return df.sparkSession.sql(query_fn(name))
    finally:
        df.sparkSession.catalog.dropTempView(name)


def record_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("record_count"))


def minmax_timestamps(df: DataFrame, fg: FeatureGroup) -> DataFrame:
    return df.agg(
        F.min(WRITE_TIME).alias("min_write_time"),
        F.max(WRITE_TIME).alias("max_write_time"),
        F.min(as_time(df, fg.event_time)).alias("min_event_time"),
        F.max(as_time(df, fg.event_time)).alias("max_event_time"),
    )


def availability(histories: Mapping[str, DataFrame], expected: Mapping[str, int]) -> DataFrame:
    """Per group: records found, records expected, and whether all have arrived."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("feature_group"),
            "record_count",
            F.lit(expected[name]).cast("long").alias("expected"),
            (F.col("record_count") >= expected[name]).alias("available"),
        )
        for name, df in histories.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def recent_writes(df: DataFrame, fg: FeatureGroup, n: int = 1000) -> DataFrame:
    """The n newest writes; equal write times are ordered by record id."""
    return df.orderBy(F.col(WRITE_TIME).desc_nulls_last(), F.col(fg.record_id).asc()).limit(n)


def bernoulli_sample(df: DataFrame, fg: FeatureGroup, percent: float, n: int, seed: int = 0) -> DataFrame:
    """Each record with the given probability, then at most n rows, those of least hash.

    Whether a record is in depends on its id and the seed alone, not on how the
    frame is partitioned.
    """
    digest = F.md5(F.concat_ws(":", F.col(fg.record_id).cast("string"), F.lit(str(seed))))
    limit = f"{min((1 << 32) - 1, int(percent / 100.0 * (1 << 32))):08x}"
    if percent >= 100:
        limit = "g"  # after every hexadecimal digit
    chosen = df.withColumn("__digest", digest).where(F.substring("__digest", 1, 8) < limit)
    return chosen.orderBy("__digest", *[F.col(c).desc_nulls_last() for c in df.columns]).limit(n).drop("__digest")


def write_time_cutoff(df: DataFrame) -> DataFrame:
    """Newest write time, clipped to whole seconds, for use as a cut-off."""
    return df.agg(F.date_trunc("second", F.max(WRITE_TIME)).alias("cutoff"))


def month_counts(df: DataFrame, time: str) -> DataFrame:
    month = F.concat_ws("-", F.year(time), F.month(time)).alias("year_month")
    return df.groupBy(month).agg(F.count(F.lit(1)).alias("record_count"))


def union_history(*frames: DataFrame, evolve: bool = False) -> DataFrame:
    """Append by column name; ``evolve`` fills features the older rows lack with null."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=evolve)
    return out


def stamp(df: DataFrame, written: Any = None, invoked: Any = None) -> DataFrame:
    """Add the system columns of a normal, live write."""
    now = F.current_timestamp()
    return df.withColumns(
        {
            WRITE_TIME: now if written is None else written,
            API_TIME: now if invoked is None else invoked,
            IS_DELETED: F.lit(False),
        }
    )
