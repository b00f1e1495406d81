"""Writing to feature groups: validation, online upserts, routing and deletes."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import (
    API_TIME,
    IS_DELETED,
    WRITE_TIME,
    FeatureGroup,
)
from tidemark.operators.latest import as_time, latest, time_literal
from tidemark.operators.select import stamp
from tidemark.session import delete_path, durable, file_system
from tidemark.sources.files import partition_stats, write_offline
from tidemark.sources.layout import of_ids
from tidemark.sources.versions import TARGET_BYTES, drop_data, list_folders

REASON = "failure_reason"
TARGETS = ("offline", "online")
MERGED = "merged"  # the writer of merged folders
DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder name of a null


def checked(df: DataFrame, fg: FeatureGroup) -> DataFrame:
    """The frame with a reason per row why it cannot be ingested; null when it can."""
    reasons: list[Column] = [
        F.lit(f"missing column {name}") for name in fg.names if name not in df.columns
    ]
    present = {f.name: f.dataType for f in df.schema.fields}
    if fg.record_id in present:
        reasons.append(F.when(F.col(fg.record_id).isNull(), F.lit(f"null {fg.record_id}")))
    if fg.event_time in present:
        reasons.append(
            F.when(F.col(fg.event_time).isNull(), F.lit(f"null {fg.event_time}")).when(
                as_time(df, fg.event_time).isNull(), F.lit(f"bad {fg.event_time}")
            )
        )
    for f in fg.schema.fields:
        if f.name in present and f.name != fg.event_time and present[f.name] != f.dataType:
            bad = F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
            reasons.append(F.when(bad, F.lit(f"cannot cast {f.name}")))
    text = F.concat_ws("; ", *reasons) if reasons else F.lit("")
    return df.withColumn(REASON, F.when(text != "", text))


def split_valid(df: DataFrame, fg: FeatureGroup) -> tuple[DataFrame, DataFrame]:
    """(rows typed as the group declares them, rejected rows as given with a reason)."""
    marked = checked(df, fg)
    failed = marked.where(F.col(REASON).isNotNull())
    missing = [n for n in fg.names if n not in df.columns]
    columns = [
        (F.lit(None) if f.name in missing else as_time(df, f.name) if f.name == fg.event_time else F.col(f.name))
        .try_cast(T.TimestampType() if f.name == fg.event_time else f.dataType)
        .alias(f.name)
        for f in fg.schema.fields
    ]
    return marked.where(F.col(REASON).isNull()).select(*columns), failed


def online_upsert(current: DataFrame, incoming: DataFrame, fg: FeatureGroup) -> DataFrame:
    """Current records after the incoming ones: an older event time never replaces a newer one.

    At equal event times the incoming row wins; a delete marker wins like any
    other row and stays as a marker. Times are compared as instants. One join of
    the current table with the newest incoming row of each record.
    """
    columns = current.columns
    newest = latest(incoming, fg, deleted="ignore").withColumn("__came", as_time(incoming, fg.event_time))
    renamed = newest.select("__came", *[F.col(c).alias(f"__new_{c}") for c in columns])
    held = current.withColumns({"__was": as_time(current, fg.event_time), "__held": F.lit(True)})
    joined = held.join(renamed, F.col(fg.record_id) == F.col(f"__new_{fg.record_id}"), "full_outer")
    known = F.coalesce(F.col("__held"), F.lit(False))
    later = F.col("__was").isNull() | (F.col("__came") >= F.col("__was"))
    wins = ~known | (F.col(f"__new_{fg.record_id}").isNotNull() & F.coalesce(later, F.lit(False)))
    return joined.select(*[F.when(wins, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) for c in columns])


def patch(online: DataFrame, changes: DataFrame, fg: FeatureGroup) -> DataFrame:
    """Change some features of some records; a null change keeps the old value.

    The newest change of a record counts, and as in `online_upsert` only if it is
    not older than the record. Changes without an event time always apply; of
    several for one record the one with the largest values does.
    """
    timed = fg.event_time in changes.columns
    if timed:
        newest = latest(changes, fg, deleted="ignore")
    else:
        others = [c for c in changes.columns if c != fg.record_id]
        newest = changes.groupBy(fg.record_id).agg(F.max(F.struct(*others)).alias("__last")).select(fg.record_id, "__last.*")
    renamed = newest.select(*[F.col(c).alias(f"__new_{c}") for c in changes.columns], *([as_time(newest, fg.event_time).alias("__came")] if timed else []))
    held = online.withColumn("__was", as_time(online, fg.event_time))
    joined = held.join(renamed, F.col(fg.record_id) == F.col(f"__new_{fg.record_id}"), "left")
    older = F.coalesce(F.col("__came") < F.col("__was"), F.lit(False)) if timed else F.lit(False)
    return joined.select(
        *[
            F.when(older, F.col(c)).otherwise(F.coalesce(F.col(f"__new_{c}"), F.col(c))).alias(c)
            if c in changes.columns else F.col(c)
            for c in online.columns
        ]
    )


def delete_markers(
    ids: DataFrame, fg: FeatureGroup, columns: DataFrame, event_time: Column, written: Column | None = None
) -> DataFrame:
    """Marker rows in the shape of ``columns``: id, event time, system columns, all else null."""
    now = F.current_timestamp() if written is None else written
    fixed = {
        fg.record_id: F.col(fg.record_id),
        fg.event_time: event_time,
        WRITE_TIME: now,
        API_TIME: now,
        IS_DELETED: F.lit(True),
    }
    return ids.select(
        *[
            (fixed[f.name].cast(f.dataType) if f.name in fixed else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in columns.schema.fields
        ]
    )


def soft_delete(
    history: DataFrame, fg: FeatureGroup, ids: DataFrame, at: Any, written: Column | None = None
) -> DataFrame:
    """History with a delete marker per id, unless the record has an event at or after ``at``."""
    wanted = ids.select(F.col(ids.columns[0]).alias(fg.record_id)).distinct()
    moment = time_literal(history, fg.event_time, at)
    blocked = history.where(as_time(history, fg.event_time) >= moment).select(fg.record_id).distinct()
    marked = wanted.join(blocked, fg.record_id, "left_anti")
    return history.unionByName(delete_markers(marked, fg, history, moment, written))


def hard_delete_online(
    online: DataFrame, history: DataFrame, fg: FeatureGroup, ids: DataFrame, at: Any, written: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(online table without the ids, history with their markers)."""
    wanted = ids.select(F.col(ids.columns[0]).alias(fg.record_id)).distinct()
    remaining = online.join(wanted, fg.record_id, "left_anti").select(*online.columns)
    return remaining, soft_delete(history, fg, wanted, at, written)


def expire_ttl(
    online: DataFrame, history: DataFrame, fg: FeatureGroup, ttl: timedelta, now: datetime, written: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(records younger than the time to live, history with a marker per expired record).

    A record without an event time has no age and is kept.
    """
    oldest = now - ttl
    moment = as_time(online, fg.event_time)
    limit = time_literal(online, fg.event_time, oldest)
    kept = online.where(moment.isNull() | (moment > limit))
    expired = online.where(moment <= limit).select(fg.record_id)
    markers = delete_markers(expired, fg, history, time_literal(history, fg.event_time, now), written)
    return kept, history.unionByName(markers)


def online_schema(fg: FeatureGroup) -> T.StructType:
    """Columns of the online table: the features, event time as a timestamp, system columns."""
    fields = [T.StructField(f.name, T.TimestampType() if f.name == fg.event_time else f.dataType) for f in fg.schema]
    times = [T.StructField(c, T.TimestampType()) for c in (WRITE_TIME, API_TIME)]
    return T.StructType([*fields, *times, T.StructField(IS_DELETED, T.BooleanType())])


def write_online(df: DataFrame, fg: FeatureGroup, path: str, batch: str | int, writer: str) -> None:
    """Add a batch's newest rows to the online table, as one delta folder.

    A folder belongs to one batch of one writer: writing that batch again
    replaces it, so a repeated batch changes nothing, and no other writer can
    touch it. Rows are sorted by id within files for point lookups.
    """
    newest = latest(df, fg, deleted="ignore")
    absent = {c: F.lit(None) for c in (WRITE_TIME, API_TIME) if c not in df.columns}
    if IS_DELETED not in df.columns:
        absent[IS_DELETED] = F.lit(False)
    newest = newest.withColumns({fg.event_time: as_time(newest, fg.event_time), **absent})
    rows = newest.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in online_schema(fg)])
    rows.sortWithinPartitions(fg.record_id).write.mode("overwrite").parquet(f"{path}/{delta_folder(writer, batch)}")


def delta_folder(writer: str, batch: str | int) -> str:
    if not re.fullmatch(r"[\w-]+", writer):
        raise ValueError(f"a writer is named by letters, digits, _ and -, not {writer!r}")
    return f"delta={writer}.{batch}"


def read_online(spark: SparkSession, path: str, fg: FeatureGroup, features: Sequence[str] | None = None) -> DataFrame:
    """Current records: the newest row per id over all deltas, deleted records left out.

    The group gives the schema, so no file has to be opened to find it, and a
    feature added later is null in older rows.
    """
    rows = spark.read.schema(online_schema(fg)).parquet(path)
    return latest(rows, fg).select(*(features or fg.names))


def compact_online(spark: SparkSession, path: str, fg: FeatureGroup) -> None:
    """Merge the deltas present into one; markers stay, to keep late rows out.

    The merged delta is written before the old ones are removed. Reading both
    gives the same records as reading either, and later deltas are not touched.
    A delta whose batch is written anew meanwhile (other files than were read) stays.
    """
    deltas = {folder: _tree(spark, folder) for folder in list_folders(spark, path)}
    if deltas:
        _merge_deltas(spark, path, fg, deltas)


def merge_tiers(spark: SparkSession, path: str, fg: FeatureGroup, fanout: int = 4, least: int = 1 << 20) -> int:
    """Merge the online deltas of each full size class until none is full; returns the number of merges.

    A row is rewritten once for each class it rises through, so often as the
    logarithm of the table, while a lookup still reads few deltas: fewer than
    `fanout` of each class. Safe against readers and late batches as `compact_online`.
    """
    merges = 0
    while True:
        deltas = {folder: _tree(spark, folder) for folder in list_folders(spark, path)}
        groups = size_tiers({f: sum(size for _, _, size in tree) for f, tree in deltas.items()}, fanout, least)
        if not groups:
            return merges
        for group in groups:
            _merge_deltas(spark, path, fg, {folder: deltas[folder] for folder in group})
            merges += 1


def _merge_deltas(spark: SparkSession, path: str, fg: FeatureGroup, deltas: dict[str, set]) -> None:
    rows = spark.read.schema(online_schema(fg)).parquet(*deltas)
    write_online(rows, fg, path, uuid.uuid4().hex, MERGED)
    for folder, files in deltas.items():
        if _tree(spark, folder) == files:
            delete_path(spark, folder)


def erase_online(spark: SparkSession, path: str, fg: FeatureGroup, ids: DataFrame) -> int:
    """Remove every row of some ids from the stored online table, old deltas included.

    Only deltas that hold such a row are written anew. Returns how many were.
    """
    wanted = durable(ids.select(F.col(ids.columns[0]).alias(fg.record_id)).distinct(), "erased")
    schema = T.StructType([*online_schema(fg), T.StructField("delta", T.StringType())])
    rows = spark.read.schema(schema).parquet(path)
    touched = durable(of_ids(rows, fg.record_id, wanted).select("delta").distinct(), "touched")
    return rewrite_partitions(
        spark, path, ["delta"], touched, lambda held: held.join(wanted, fg.record_id, "left_anti").select(*held.columns), schema)


def expire_online(spark: SparkSession, path: str, fg: FeatureGroup, ttl: timedelta, now: datetime) -> DataFrame:
    """Remove records older than the time to live from the stored online table; returns their ids.

    The returned frame is fixed before anything is removed, so it can be used to
    write their markers to the history.
    """
    current = read_online(spark, path, fg)
    limit = time_literal(current, fg.event_time, now - ttl)
    expired = durable(current.where(as_time(current, fg.event_time) <= limit).select(fg.record_id), "expired")
    erase_online(spark, path, fg, expired)
    return expired


def ingest(
    df: DataFrame,
    fg: FeatureGroup,
    targets: Sequence[str],
    *,
    offline_path: str | None = None,
    online_path: str | None = None,
    batch: str | int | None = None,
    writer: str | None = None,
    grain: str = "hour",
    written: Column | None = None,
) -> DataFrame:
    """Validate a frame and write it to the chosen stores; returns the rejected rows.

    A write to the online table is replicated to the history by naming both
    targets. It needs the writer's name and its number of the batch: the same
    pair replaces what it wrote before, any other pair adds to it.
    """
    unknown = [t for t in targets if t not in TARGETS]
    if unknown or not targets:
        raise ValueError(f"targets must be among {TARGETS}, not {list(targets)}")
    if "online" in targets and (batch is None or writer is None):
        raise ValueError("a write to the online table needs a batch and a writer")
    valid, failed = split_valid(df, fg)
    rows = stamp(valid, written, written)
    if len(targets) > 1:
        rows = durable(rows, "ingest")
    if "offline" in targets:
        write_offline(rows, fg, offline_path, stamped=True, grain=grain)
    if "online" in targets:
        write_online(rows, fg, online_path, batch, writer)
    return failed


def hard_delete_offline(spark: SparkSession, path: str, fg: FeatureGroup, keys: Sequence[str]) -> int:
    """Erase marked records from a partitioned history, rewriting only the partitions that hold them.

    Values go first and markers second: a run broken off leaves every marker
    that is still needed, and the next run finishes the work. Returns the number
    of partition rewrites.
    """
    check_layout(spark, path, keys)
    history = spark.read.parquet(path)
    marked = durable(history.where(F.col(IS_DELETED)).select(fg.record_id).distinct(), "marked")
    live = ~F.coalesce(F.col(IS_DELETED), F.lit(False))

    def places(rows: DataFrame) -> DataFrame:
        return durable(of_ids(rows, fg.record_id, marked).select(*keys).distinct(), "touched")

    def without_values(rows: DataFrame) -> DataFrame:
        kept = rows.where(live).join(marked, fg.record_id, "left_anti").select(*rows.columns)
        return kept.unionByName(rows.where(~live))

    def without_markers(rows: DataFrame) -> DataFrame:
        return rows.join(marked, fg.record_id, "left_anti").select(*rows.columns)

    values = rewrite_partitions(spark, path, keys, places(history.where(live)), without_values)
    markers = places(spark.read.parquet(path).where(F.col(IS_DELETED)))
    return values + rewrite_partitions(spark, path, keys, markers, without_markers)


def compact_offline(spark: SparkSession, path: str, keys: Sequence[str], target_bytes: int = TARGET_BYTES, order: Sequence[str] | None = None) -> int:
    """Merge the small files of a partitioned history, rewriting only partitions with too many files.

    File sizes follow spark.sql.adaptive.advisoryPartitionSizeInBytes. Returns
    the number of partitions rewritten; a second run finds none. Rows of a file are sorted by
    `order`, by default the times in the table's order: dictionaries of merged files are larger, and
    without an order of the rows a merged file may be larger than its parts.
    """
    check_layout(spark, path, keys)
    stats = partition_stats(spark, path)
    crowded = stats.where(F.col("file_count") > F.ceil(F.col("total_size") / target_bytes))
    types = {f.name: f.dataType for f in spark.read.parquet(path).schema.fields}
    if order is None:
        order = [c for c, t in types.items() if isinstance(t, (T.TimestampType, T.TimestampNTZType)) and c not in keys]
    types = {k: T.StringType() if isinstance(t, T.NullType) else t for k, t in types.items()}  # only nulls so far
    values = []
    for k in keys:
        value = F.regexp_extract("partition", f"(?:^|/){k}=([^/]+)", 1)
        values.append(F.when(value != DEFAULT_PARTITION, F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))).cast(types[k]).alias(k))
    touched = durable(crowded.select(*values), "touched")
    return rewrite_partitions(spark, path, keys, touched, lambda rows: rows, order=order)


def compact_stream(spark: SparkSession, path: str, keys: Sequence[str], fanout: int = 2) -> None:
    """Merge batch folders of a streamed history into one, partitioned by the keys.

    A stream that lost its last commit writes that micro-batch again, into the
    same folder, so each writer's newest batch stays as it is. All other batches are merged, of whatever sizes; folders merged
    before are merged again only in size tiers, as online deltas are. The merged folder is written before the old
    ones go, in the shared folder first. Readers should not run between, as they would see rows twice.
    """
    batches = {folder: _tree(spark, folder) for folder in list_folders(spark, path) if "/batch=" in folder}
    newest: dict[str, int] = {}
    for folder in batches:
        writer, number = folder_batch(folder)
        if number is not None:
            newest[writer] = max(number, newest.get(writer, number))
    done = {f: tree for f, tree in batches.items() if newest.get(folder_batch(f)[0]) != folder_batch(f)[1] or folder_batch(f)[1] is None}
    fresh = sorted(f for f in done if folder_batch(f)[1] is not None)
    if len(fresh) < 2:  # a single batch goes with merged folders of its size
        fresh = []
    tiers = size_tiers({f: sum(size for _, _, size in tree) for f, tree in done.items() if f not in fresh}, fanout)
    for group in [*([fresh] if fresh else []), *tiers]:
        rows = spark.read.option("basePath", path).parquet(*group).drop("batch")
        staged = durable(rows, "merged")
        staged.hint("rebalance", *keys).write.partitionBy(*keys).parquet(f"{path}/batch=merged.{uuid.uuid4().hex}")
        for folder in group:
            if _tree(spark, folder) == batches[folder]:
                delete_path(spark, folder)


def folder_batch(folder: str) -> tuple[str, int | None]:
    """Writer and batch number that name a folder; merged ones have no number."""
    writer, _, batch = folder.rsplit("=", 1)[1].rpartition(".")
    return writer, int(batch) if batch.isdigit() and writer != MERGED else None


def size_tiers(sizes: dict[str, int], fanout: int = 4, least: int = 1 << 20) -> list[list[str]]:
    """Folders to merge together: all of one size class, once it holds `fanout` of them.

    Classes are powers of `fanout` from `least` bytes on, so a row moves to a
    higher class whenever it is rewritten: a logarithmic number of times.
    """
    classes: dict[int, list[str]] = {}
    for folder, size in sorted(sizes.items()):
        tier = 0
        while size >= least * fanout**tier:
            tier += 1
        classes.setdefault(tier, []).append(folder)
    return [folders for _, folders in sorted(classes.items()) if len(folders) >= fanout]


def _tree(spark: SparkSession, folder: str) -> set[tuple[str, int, int]]:
    """Files below a folder with their times and sizes."""
    fs, target = file_system(spark, folder)
    found, files = fs.listFiles(target, True), set()
    while found.hasNext():
        status = found.next()
        files.add((str(status.getPath()), status.getModificationTime(), status.getLen()))
    return files


def check_layout(spark: SparkSession, path: str, keys: Sequence[str]) -> None:
    """Refuse keys other than those the folders below the path are named by, before anything is written."""
    names, folder = [], path
    while found := [m for f in list_folders(spark, folder) if (m := re.search(r"/(([^/=]+)=[^/]*)$", f))]:
        if len({m.group(2) for m in found}) > 1:
            raise ValueError(f"{folder} is partitioned by several columns at once")
        names.append(found[0].group(2))
        folder = f"{folder.rstrip('/')}/{found[0].group(1)}"
    if names != list(keys):
        raise ValueError(f"{path} is partitioned by {names}, not {list(keys)}")


def rewrite_partitions(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    touched: DataFrame,
    change: Callable[[DataFrame], DataFrame],
    schema: T.StructType | None = None,
    order: Sequence[str] = (),
) -> int:
    """Replace the content of some partitions by a change of it, in files sorted by `order`.

    The new content is written to the shared folder first, so nothing being read
    is overwritten, and a copy outlives a failed replacement. A partition left
    without rows loses its folder.
    """
    count = touched.count()
    if count == 0:
        return 0
    history = (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    inside = history.join(touched, [history[k].eqNullSafe(touched[k]) for k in keys], "left_semi")
    staged = durable(change(inside), "rewritten")
    placed = staged.hint("rebalance", *keys)
    placed = placed.sortWithinPartitions(*keys, *order) if order else placed
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(path)
    # Dynamic overwrite leaves alone a partition that no row remains in.
    left = staged.select(*keys).distinct()
    emptied = touched.join(left, [touched[k].eqNullSafe(left[k]) for k in keys], "left_anti").distinct()
    for row in emptied.toLocalIterator():  # one folder each
        folders = [path]
        for k in keys:
            folders.append(_partition_folder(spark, folders[-1], k, row[k]))
        drop_data(spark, folders.pop(), confirm=True)
        while len(folders) > 1 and not list_folders(spark, folders[-1]):
            drop_data(spark, folders.pop(), confirm=True)
    return count


def _partition_folder(spark: SparkSession, folder: str, key: str, value: Any) -> str:
    """The folder of a partition value, by the name it has in the listing."""
    for found in list_folders(spark, folder):
        name, _, text = found.rsplit("/", 1)[1].partition("=")
        plain = None if text == DEFAULT_PARTITION else unquote(text)
        if name == key and (plain is None if value is None else plain is not None and _same(plain, value)):
            return found
    raise FileNotFoundError(f"{folder} has no partition {key}={value}")


def _same(text: str, value: Any) -> bool:
    return int(text) == value if isinstance(value, int) and re.fullmatch(r"-?\d+", text) else text == str(value)
