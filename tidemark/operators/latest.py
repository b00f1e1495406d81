"""Newest state of a history: one function, four named variants of "latest"."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import (
    API_TIME,
    IS_DELETED,
    PARTITION_COLUMNS,
    SYSTEM_COLUMNS,
    WRITE_TIME,
    FeatureGroup,
)
from tidemark.skew import Skew, hot_groups

# Up to this n Catalyst ranks inside each map task before the shuffle
# (spark.sql.optimizer.windowGroupLimitThreshold); beyond it we pre-rank ourselves.
GROUP_LIMIT = 1000
SALTS = 256

_RANK = "__rank"


def as_time(df: DataFrame, name: str) -> Column:
    """A column as a point in time: ISO-8601 text, epoch seconds or a timestamp."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(F.col(name))
    if isinstance(dtype, T.NumericType):
        return F.timestamp_seconds(F.col(name))
    return F.col(name)


def time_literal(df: DataFrame, name: str, value: Any) -> Column:
    """A time bound in the type of the column, so that the scan can use it."""
    dtype = df.schema[name].dataType
    literal = value if isinstance(value, Column) else F.lit(value)
    if isinstance(value, str):
        # Text bounds are upper-cased first: '2020-01-01t00:00:00z' is accepted.
        # An offset in the text counts, so it becomes an instant before the column's type.
        literal = F.lit(value.upper()).cast("timestamp")
    if isinstance(dtype, (T.StringType, T.NumericType)):
        return literal.cast("timestamp")
    return literal.cast(dtype)


def order_columns(df: DataFrame, fg: FeatureGroup, order: str = "full") -> list[Column]:
    """Newest first; equal rows are separated by their feature values, so the choice is stable."""
    keys = [as_time(df, fg.event_time).desc_nulls_last()]
    if order == "full":
        keys += [F.col(c).desc_nulls_last() for c in (API_TIME, WRITE_TIME) if c in df.columns]
    elif order != "event_time":
        raise ValueError(f"order must be 'full' or 'event_time', not {order!r}")
    return keys


def tie_break(df: DataFrame, fg: FeatureGroup) -> list[Column]:
    return [
        F.col(f.name).desc_nulls_last()
        for f in df.schema.fields
        if f.name not in (fg.record_id, fg.event_time, API_TIME, WRITE_TIME)
        and not isinstance(f.dataType, T.MapType)
    ]


def latest(
    history: DataFrame,
    fg: FeatureGroup,
    *,
    ties: str = "first",
    deleted: str = "after",
    order: str = "full",
    as_of: Any = None,
    n: int = 1,
    ids: DataFrame | Sequence | None = None,
    features: Sequence[str] | None = None,
    skew: Skew | None = Skew(),
) -> DataFrame:
    """The newest ``n`` rows per record id.

    ties     'first' keeps one row per rank, 'all' keeps every row tied with it
    deleted  'after' ranks first, so a marker hides the record; 'before' drops
             markers first, so an older row reappears; 'ignore' keeps markers
    order    'full' = event, API and write time; 'event_time' = event time only
    as_of    only rows with event time up to this instant take part

    Ranking happens inside each map task before the shuffle, so a record id
    holding a large share of the history sends at most ``n`` rows per task. Tied
    rows that are all to be kept could still be too many for one task: in large
    inputs they are counted, and a large tie is kept by a join instead.
    """
    if ties not in ("first", "all"):
        raise ValueError(f"ties must be 'first' or 'all', not {ties!r}")
    if deleted not in ("after", "before", "ignore"):
        raise ValueError(f"deleted must be 'after', 'before' or 'ignore', not {deleted!r}")
    df = history
    if ids is not None:
        df = by_ids(df, fg.record_id, ids)
    if as_of is not None:
        df = df.where(as_time(df, fg.event_time) <= time_literal(df, fg.event_time, as_of))
    if deleted == "before":
        df = df.where(~F.col(IS_DELETED))
    if features is not None:
        df = df.select(*dict.fromkeys([fg.record_id, fg.event_time, *features, *_present_system(df)]))
    newest = order_columns(df, fg, order)
    if ties == "first":
        newest += tie_break(df, fg)
        rank = F.row_number()
    else:
        rank = F.dense_rank()
    if ties == "all" and skew is not None and skew.applies(df) and _large_ties(df, fg, order, skew):
        df = _joined_ties(df, fg, order, n)
    else:
        df = _ranked(df, fg, newest, rank, n)
    if deleted == "after":
        df = df.where(~F.col(IS_DELETED))
    return df.select(*features) if features is not None else df


def _ranked(df: DataFrame, fg: FeatureGroup, newest: list[Column], rank: Column, n: int) -> DataFrame:
    if n > GROUP_LIMIT:
        df = _salted_limit(df, fg.record_id, newest, rank, n)
    w = Window.partitionBy(fg.record_id).orderBy(*newest)
    return df.withColumn(_RANK, rank.over(w)).where(F.col(_RANK) <= n).drop(_RANK)


def _order_values(df: DataFrame, fg: FeatureGroup, order: str) -> dict[str, Column]:
    values = [as_time(df, fg.event_time)]
    if order == "full":
        values += [F.col(c) for c in (API_TIME, WRITE_TIME) if c in df.columns]
    return {f"__o{i}": v for i, v in enumerate(values)}


def _large_ties(df: DataFrame, fg: FeatureGroup, order: str, skew: Skew) -> bool:
    values = _order_values(df, fg, order)
    narrow = df.select(F.col(fg.record_id).alias("__id"), *[v.alias(k) for k, v in values.items()])
    return hot_groups(narrow, narrow.columns, skew) is not None


def _joined_ties(df: DataFrame, fg: FeatureGroup, order: str, n: int) -> DataFrame:
    """Rank distinct times only, then keep the rows at those times by a semi join.

    The join may split a tie over many tasks, which a window cannot.
    """
    values = _order_values(df, fg, order)
    timed = df.withColumns(values)
    times = timed.select(F.col(fg.record_id).alias("__id"), *[F.col(k).alias(f"{k}r") for k in values]).distinct()
    w = Window.partitionBy("__id").orderBy(*[F.col(f"{k}r").desc_nulls_last() for k in values])
    top = times.withColumn(_RANK, F.row_number().over(w)).where(F.col(_RANK) <= n).drop(_RANK)
    same = [F.col(fg.record_id).eqNullSafe(F.col("__id")), *[F.col(k).eqNullSafe(F.col(f"{k}r")) for k in values]]
    return timed.join(top, same, "left_semi").drop(*values)


def _present_system(df: DataFrame) -> list[str]:
    return [c for c in SYSTEM_COLUMNS if c in df.columns]


def _salted_limit(df: DataFrame, key: str, newest: list[Column], rank: Column, n: int) -> DataFrame:
    """First n per (key, salt): holds the first n per key, since a row never ranks worse in its salt."""
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
    first = Window.partitionBy(key, "__salt").orderBy(*newest)
    return salted.withColumn(_RANK, rank.over(first)).where(F.col(_RANK) <= n).drop(_RANK, "__salt")


def as_of(history: DataFrame, fg: FeatureGroup, instant: Any, **options) -> DataFrame:
    """State of every record at one event time."""
    return latest(history, fg, as_of=instant, **options)


def recent(history: DataFrame, fg: FeatureGroup, n: int, **options) -> DataFrame:
    """The n most recent rows per record."""
    return latest(history, fg, n=n, **options)


def materialized(history: DataFrame, fg: FeatureGroup, mode: str = "strict") -> DataFrame:
    """Current records as the online table holds them: no system or partition columns.

    'strict' hides deleted records; 'event_time_only' ranks by event time alone
    and lets a marker through as a row of nulls.
    """
    if mode == "strict":
        current = latest(history, fg)
    elif mode == "event_time_only":
        current = latest(history, fg, order="event_time", deleted="ignore")
    else:
        raise ValueError(f"mode must be 'strict' or 'event_time_only', not {mode!r}")
    return drop_system(current)


def drop_system(df: DataFrame) -> DataFrame:
    return df.drop(*SYSTEM_COLUMNS, *PARTITION_COLUMNS)


def by_ids(df: DataFrame, key: str, ids: DataFrame | Sequence | None) -> DataFrame:
    """Rows of the given record ids; None means all, an empty list means none.

    A frame of ids becomes a semi join on its first column and may be of any
    size: Catalyst broadcasts it only when it is small.
    """
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        wanted = ids.select(F.col(ids.columns[0]).alias(key)).distinct()
        return df.join(wanted, key, "left_semi")
    return df.where(F.col(key).isin(list(ids)))


def rows_as_of_write_time(df: DataFrame, instant: Any) -> DataFrame:
    """Rows that had been written by the given instant."""
    return df.where(F.col(WRITE_TIME) <= time_literal(df, WRITE_TIME, instant))


def event_time_range(df: DataFrame, fg: FeatureGroup, start: Any = None, end: Any = None) -> DataFrame:
    """Rows whose event time lies between the bounds, both included; either may be left out."""
    if start is not None:
        df = df.where(as_time(df, fg.event_time) >= time_literal(df, fg.event_time, start))
    if end is not None:
        df = df.where(as_time(df, fg.event_time) <= time_literal(df, fg.event_time, end))
    return df
