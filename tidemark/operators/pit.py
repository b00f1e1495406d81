"""Point-in-time joins: per spine row, the state of a record at that row's time.

The history and the spine are united, sorted by record and time, and each spine
row takes the last history row before it: one shuffle, work linear in the rows,
and no pairs of spine and history rows are formed. Groups that share a record id
share the shuffle.

A record holding a large share of the rows would sort in one task. Such hot
records are found by a count per record and cut into time slices with
near-equal row counts; each slice starts from the newest row of the slices
before it, so the result is the same.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import IS_DELETED, WRITE_TIME, FeatureGroup, parse_features
from tidemark.operators.latest import as_time
from tidemark.session import durable
from tidemark.skew import Skew, hot_slices, slice_number
from tidemark.sources.layout import bucket_count

_K, _T, _SIDE, _W, _B, _S = "__key", "__time", "__side", "__written", "__slice", "__spine"


@dataclass(frozen=True)
class Request:
    """One feature group to look up, with its history and the features wanted."""

    fg: FeatureGroup
    history: DataFrame
    features: tuple[str, ...]


def pit_join(
    spine: DataFrame,
    spine_time: str,
    fg: FeatureGroup,
    history: DataFrame,
    features: Sequence[str] | None = None,
    *,
    spine_key: str | None = None,
    names: Mapping[str, str] | None = None,
    strict: bool = False,
    strategy: str = "union_last",
    skew: Skew | None = Skew(),
) -> DataFrame:
    """Every spine row with the features of its record as of ``spine_time``.

    The newest history row with event time up to the spine time counts, the
    later write among equal event times. If it is a delete marker, or if there
    is none, the features are null. ``strict`` excludes equal times.

    ``strategy="bucketed"`` is for a history stored by ``write_bucketed``: it is
    read in place and only the spine is shuffled, to as many partitions.
    """
    wanted = tuple(fg.core_features if features is None else features)
    request = Request(fg, history, wanted)
    key = spine_key or fg.record_id
    if strategy == "join_rank":
        found = _join_rank(spine, spine_time, key, request, strict)
    elif strategy == "union_last":
        found = _lookup(spine, spine_time, key, [request], strict, skew)
    elif strategy == "bucketed":
        found = _bucketed(spine, spine_time, key, request, strict, skew)
    else:
        raise ValueError(f"strategy must be 'union_last', 'bucketed' or 'join_rank', not {strategy!r}")
    names = names or {}
    taken = {c.lower() for c in spine.columns}
    clash = [f for f in wanted if names.get(f, f).lower() in taken]
    if clash:
        raise ValueError(f"features {clash} are spine columns too; rename them with names=")
    return found.select(*spine.columns, *[_value(0, f).alias(names.get(f, f)) for f in wanted])


def get_features(
    spine: DataFrame,
    spine_time: str,
    features: Sequence[str],
    groups: Mapping[str, FeatureGroup],
    histories: Mapping[str, DataFrame],
    *,
    keys: Mapping[str, str] | None = None,
    suffix: str = "_{}",
    strict: bool = False,
    skew: Skew | None = Skew(),
) -> DataFrame:
    """Training set over several groups: spine columns first, then features as requested.

    Feature names come out in lower case. A feature that is a spine column
    already is not repeated; one found in two groups gets a numbered suffix.
    Groups looked up by the same spine column are answered by one shuffle.
    """
    keys = keys or {}
    spine_columns = {c.lower() for c in spine.columns}
    wanted = [(fg, f) for fg, f in parse_features(features, groups) if f.lower() not in spine_columns]
    per_key: dict[str, dict[str, list[str]]] = {}
    for fg, feature in wanted:
        key = keys.get(fg.name, fg.record_id)
        per_key.setdefault(key, {}).setdefault(fg.name, []).append(feature)

    output: dict[tuple[str, str], str] = {}
    used: set[str] = set(spine_columns)
    for fg, feature in wanted:
        name, k = feature.lower(), 0
        while name in used:
            k += 1
            name = feature.lower() + suffix.format(k)
        used.add(name)
        output[fg.name, feature] = name

    df = spine
    for key, by_group in per_key.items():
        requests = [Request(groups[g], histories[g], tuple(fs)) for g, fs in by_group.items()]
        kept = df.columns
        found = _lookup(df, spine_time, key, requests, strict, skew)
        values = [
            _value(i, f).alias(output[r.fg.name, f]) for i, r in enumerate(requests) for f in r.features
        ]
        df = found.select(*kept, *values)
    return df.select(*spine.columns, *[output[fg.name, f] for fg, f in wanted])


def pit_recent(
    spine: DataFrame,
    spine_time: str,
    fg: FeatureGroup,
    history: DataFrame,
    features: Sequence[str] | None = None,
    *,
    n: int,
    spine_key: str | None = None,
    names: Mapping[str, str] | None = None,
    strict: bool = False,
    skew: Skew | None = Skew(),
    how: str = "left",
) -> DataFrame:
    """Up to n newest history rows per spine row.

    Delete markers count among the n. 'left' returns them as rows of nulls, as
    it does once for a spine row without history; 'inner' returns neither.

    History rows are numbered per record in time order; the point-in-time
    lookup finds the last number, and the n numbers up to it are fetched by an
    equality join. The rows joined are those returned, however long a history is.
    """
    wanted = tuple(fg.core_features if features is None else features)
    names = names or {}
    key = spine_key or fg.record_id
    request = Request(fg, history, wanted)
    if n == 1:
        found = _lookup(spine, spine_time, key, [request], strict, skew)
        if how == "inner":
            found = found.where("NOT __h0.is_deleted")
        return found.select(*spine.columns, *[_value(0, f).alias(names.get(f, f)) for f in wanted])
    hot = hot_records([_spine(spine, spine_time, key), _history(request, 0)], skew)
    numbered = _numbered(request, n, hot)
    counter = FeatureGroup(
        fg.name, _K, _T, T.StructType([f for f in numbered.schema.fields if f.name in (_K, _T, "__n")])
    )
    as_history = numbered.select(_K, _T, "__n", F.lit(False).alias(IS_DELETED))
    last = _lookup_known(spine, spine_time, key, [Request(counter, as_history, ("__n",))], strict, hot)
    last = last.select(*spine.columns, F.expr("__h0.__n").alias("__last"))
    steps = F.sequence(F.greatest(F.lit(1).cast("long"), F.col("__last") - (n - 1)), F.col("__last"))
    wide = last.withColumn("__n", F.explode_outer(steps)).drop("__last")
    rows = numbered.select(F.col(_K).alias("__k2"), F.col("__n").alias("__n2"), "__h0")
    if how == "inner":
        rows = rows.where("NOT __h0.is_deleted")
    joined = wide.join(rows, (F.col(key) == F.col("__k2")) & (F.col("__n") == F.col("__n2")), how)
    return joined.select(*spine.columns, *[_value(0, f).alias(names.get(f, f)) for f in wanted])


def _value(i: int, feature: str) -> Column:
    """A feature of request i, or null where the row found is a delete marker."""
    row = F.col(f"__h{i}")
    return F.when(~row[IS_DELETED], row[feature])


def _history(request: Request, i: int) -> DataFrame:
    """Key, time, write time and the payload struct ``__h<i>`` of a history."""
    df, fg = request.history, request.fg
    missing = [f for f in request.features if f not in df.columns]
    if missing:
        raise ValueError(f"history of {fg.name!r} lacks {missing}")
    written = F.col(WRITE_TIME) if WRITE_TIME in df.columns else F.lit(None).cast("timestamp")
    deleted = F.col(IS_DELETED) if IS_DELETED in df.columns else F.lit(False)
    payload = F.struct(*[F.col(f) for f in request.features], deleted.alias(IS_DELETED))
    return df.select(
        F.col(fg.record_id).alias(_K),
        as_time(df, fg.event_time).alias(_T),
        written.alias(_W),
        payload.alias(f"__h{i}"),
    ).where(F.col(_K).isNotNull() & F.col(_T).isNotNull())


def _spine(spine: DataFrame, spine_time: str, key: str) -> DataFrame:
    return spine.select(
        F.col(key).alias(_K),
        as_time(spine, spine_time).alias(_T),
        F.struct(*[F.col(c) for c in spine.columns]).alias(_S),
    )


def _lookup(
    spine: DataFrame, spine_time: str, key: str, requests: list[Request], strict: bool, skew: Skew | None
) -> DataFrame:
    """Spine columns plus one payload struct ``__h<i>`` per request."""
    sides = [_spine(spine, spine_time, key), *[_history(r, i) for i, r in enumerate(requests)]]
    return _lookup_known(spine, spine_time, key, requests, strict, hot_records(sides, skew))


def _lookup_known(
    spine: DataFrame, spine_time: str, key: str, requests: list[Request], strict: bool, hot: DataFrame | None
) -> DataFrame:
    rows = _spine(spine, spine_time, key)
    histories = [_history(r, i) for i, r in enumerate(requests)]
    if hot is None:
        found = _sweep(rows, histories, strict)
    else:
        cold = _sweep(_cold(rows, hot), [_cold(h, hot) for h in histories], strict)
        found = cold.unionByName(_sweep_hot(rows, histories, strict, hot))
    return found.select(f"{_S}.*", *[f"__h{i}" for i in range(len(requests))])


def hot_records(frames: list[DataFrame], skew: Skew | None) -> DataFrame | None:
    """Hot records of the spine and the histories together, with their slice bounds, or None."""
    if skew is None or not skew.applies(*frames):
        return None
    narrow = [f.select(_K, F.col(_T).cast("timestamp").alias(_T)) for f in frames]
    return hot_slices(_union(narrow), _K, _T, skew)


def _cold(df: DataFrame, hot: DataFrame) -> DataFrame:
    return df.join(F.broadcast(hot.select(_K)), _K, "left_anti")


def _sliced(df: DataFrame, hot: DataFrame) -> DataFrame:
    """Hot rows with the number of their time slice; equal times share a slice."""
    joined = df.join(F.broadcast(hot), _K)
    return joined.withColumn(_B, slice_number(F.col(_T).cast("timestamp"))).drop("bounds", "coarse")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def _sides(strict: bool) -> tuple[int, int]:
    """Sort positions of history and spine rows at equal times."""
    return (1, 0) if strict else (0, 1)


def _sorted_by(count: int, lead: Sequence[Column] = ()) -> list[Column]:
    """Time order; later writes, then larger values, come last and so win."""
    payloads = [F.col(f"__h{i}").asc_nulls_first() for i in range(count)]
    return [*lead, F.col(_T).asc_nulls_first(), F.col(_SIDE), F.col(_W).asc_nulls_first(), *payloads]


def _fill(df: DataFrame, count: int, keys: list[Column], order: list[Column]) -> DataFrame:
    """Carry the last payload of each request forward along the order."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({f"__h{i}": F.last(f"__h{i}", ignorenulls=True).over(w) for i in range(count)})


def _sweep(rows: DataFrame, histories: list[DataFrame], strict: bool) -> DataFrame:
    h_side, s_side = _sides(strict)
    united = _union(
        [h.withColumn(_SIDE, F.lit(h_side)) for h in histories] + [rows.withColumn(_SIDE, F.lit(s_side))]
    )
    # Spine rows without an id match nothing; they are spread instead of meeting in one task.
    spread = F.when(F.col(_K).isNull(), F.pmod(F.xxhash64(_S), F.lit(1024))).otherwise(0)
    n = len(histories)
    filled = _fill(united, n, [F.col(_K), spread], _sorted_by(n))
    return filled.where(F.col(_SIDE) == s_side).select(_S, *[f"__h{i}" for i in range(n)])


def _sweep_hot(rows: DataFrame, histories: list[DataFrame], strict: bool, hot: DataFrame) -> DataFrame:
    """The same lookup for hot records, in slices of (record, time range)."""
    h_side, s_side = _sides(strict)
    n = len(histories)
    rows = _sliced(rows, hot)
    # Repeated (record, time) pairs are looked up once and joined back.
    keys = rows.where(F.col(_T).isNotNull()).select(_K, _T, _B).distinct()
    best = []
    for i, history in enumerate(histories):
        w = Window.partitionBy(_K, _T).orderBy(F.col(_W).desc_nulls_last(), F.col(f"__h{i}").desc_nulls_last())
        one = _sliced(history, hot).withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")
        best.append(durable(one, "hot-history"))  # read twice below

    # Newest row of each slice, carried to the start of every later slice with spine rows.
    tails = [
        b.groupBy(_K, _B).agg(F.max_by(f"__h{i}", _T).alias(f"__h{i}")).withColumn(_SIDE, F.lit(1))
        for i, b in enumerate(best)
    ]
    starts = keys.select(_K, _B).distinct().withColumn(_SIDE, F.lit(0))
    carried = _fill(_union([*tails, starts]), n, [F.col(_K)], [F.col(_B), F.col(_SIDE)])
    carried = carried.where(F.col(_SIDE) == 0).withColumn(_SIDE, F.lit(-1))

    united = _union(
        [b.withColumn(_SIDE, F.lit(h_side)) for b in best]
        + [carried, keys.withColumn(_SIDE, F.lit(s_side))]
    )
    filled = _fill(united, n, [F.col(_K), F.col(_B)], _sorted_by(n))
    found = filled.where((F.col(_SIDE) == s_side) & F.col(_T).isNotNull())
    found = found.select(F.col(_K).alias("__k2"), F.col(_T).alias("__t2"), *[f"__h{i}" for i in range(n)])
    joined = rows.join(found, (F.col(_K) == F.col("__k2")) & (F.col(_T) == F.col("__t2")), "left")
    return joined.select(_S, *[f"__h{i}" for i in range(n)])


def _bucketed(spine: DataFrame, spine_time: str, key: str, request: Request, strict: bool, skew: Skew | None) -> DataFrame:
    """Cogroup the spine with a history that is bucketed by record id already.

    A task holds the times of one record at once, as Arrow columns; hot records
    are cut into time slices by the sweep instead, as they are elsewhere.
    """
    buckets = bucket_count(request.history)
    if buckets is None:
        raise ValueError(f"the history of {request.fg.name!r} is no bucketed table")
    rows, history = _spine(spine, spine_time, key), _history(request, 0)
    payload = history.schema["__h0"].dataType
    hot = hot_records([rows, history], skew)
    cold_rows, cold = (rows, history) if hot is None else (_cold(rows, hot), _cold(history, hot))
    matching = F.col(_K).isNotNull() & F.col(_T).isNotNull()
    w = Window.partitionBy(_K, _T).orderBy(F.col(_W).desc_nulls_last(), F.col("__h0").desc_nulls_last())
    best = cold.withColumn("__r", F.row_number().over(w)).where("__r = 1")  # within a record, so nothing moves
    best = best.select(F.col(_K).alias("__k2"), F.unix_micros(F.col(_T).cast("timestamp")).alias("__t2"), "__h0")
    asked = cold_rows.where(matching).select(_K, F.unix_micros(F.col(_T).cast("timestamp")).alias(_T), _S).repartition(buckets, _K)
    side = "left" if strict else "right"

    def take(spine_rows: pa.Table, history_rows: pa.Table) -> pa.Table:
        times = history_rows["__t2"].to_numpy()
        order = np.argsort(times, kind="stable")
        at = np.searchsorted(times[order], spine_rows[_T].to_numpy(), side=side) - 1
        found = pa.array(order[np.maximum(at, 0)], mask=at < 0) if len(order) else pa.nulls(len(at), pa.int64())
        taken = history_rows["__h0"].combine_chunks().take(found)
        return pa.table({_S: spine_rows[_S], "__h0": taken})

    schema = T.StructType([T.StructField(_S, rows.schema[_S].dataType), T.StructField("__h0", payload)])
    found = asked.groupBy(_K).cogroup(best.groupBy("__k2")).applyInArrow(take, schema)
    found = found.unionByName(cold_rows.where(~matching).select(_S, F.lit(None).cast(payload).alias("__h0")))
    if hot is not None:
        found = found.unionByName(_sweep_hot(rows, [history], strict, hot))
    return found.select(f"{_S}.*", "__h0")


def _join_rank(spine: DataFrame, spine_time: str, key: str, request: Request, strict: bool) -> DataFrame:
    """Join, filter and rank: fine for short histories, many pairs for long ones."""
    rows = _spine(spine, spine_time, key)
    keys = rows.select(F.col(_K).alias("__k2"), F.col(_T).alias("__t2")).distinct()
    history = _history(request, 0)
    before = F.col(_T) < F.col("__t2") if strict else F.col(_T) <= F.col("__t2")
    pairs = keys.join(history, (F.col("__k2") == F.col(_K)) & before)
    w = Window.partitionBy("__k2", "__t2").orderBy(
        F.col(_T).desc(), F.col(_W).desc_nulls_last(), F.col("__h0").desc_nulls_last()
    )
    found = pairs.withColumn("__r", F.row_number().over(w)).where("__r = 1").select("__k2", "__t2", "__h0")
    joined = rows.join(found, (F.col(_K) == F.col("__k2")) & (F.col(_T) == F.col("__t2")), "left")
    return joined.select(f"{_S}.*", "__h0")


def _numbered(request: Request, n: int, hot: DataFrame | None) -> DataFrame:
    """History rows numbered 1, 2, … per record in time order (column ``__n``)."""
    history = _history(request, 0)
    order = [F.col(_T), F.col(_W).asc_nulls_first(), F.col("__h0").asc_nulls_first()]
    if hot is None:
        return history.withColumn("__n", F.row_number().over(Window.partitionBy(_K).orderBy(*order)).cast("long"))
    plain = _cold(history, hot).withColumn(
        "__n", F.row_number().over(Window.partitionBy(_K).orderBy(*order)).cast("long")
    )
    # Only the last n rows of one instant can ever be among the n newest.
    w = Window.partitionBy(_K, _T).orderBy(F.col(_W).desc_nulls_last(), F.col("__h0").desc_nulls_last())
    few = _sliced(history, hot).withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n).drop("__r")
    few = durable(few, "hot-history")  # read twice below
    sizes = few.groupBy(_K, _B).agg(F.count(F.lit(1)).alias("__size"))
    before = Window.partitionBy(_K).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_K, _B, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy(_K, _B).orderBy(*order))
    # One row per hot record and slice, no more than there are slice bounds.
    sliced = few.withColumn("__i", inside).join(F.broadcast(offsets), [_K, _B])
    sliced = sliced.withColumn("__n", F.col("__before") + F.col("__i")).select(*plain.columns)
    return plain.unionByName(durable(sliced, "hot-numbered"))
