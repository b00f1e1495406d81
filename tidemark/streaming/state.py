"""Current records kept as state of the stream: only what changed leaves a micro-batch.

`upsert_stream` holds the newest row of every record in the state store (RocksDB, so state
may exceed memory; changes are logged, so a checkpoint costs as much as changed). A row older
than the one held changes nothing, in whatever order rows come; the tasks that read the stream drop such rows of their
own before the state sees them. With a time to live a
timer runs per record in event time: when the watermark passes the record's event time
plus the time to live, the record leaves the state and a delete marker goes out.

What goes out is written as deltas of the online table, one folder per micro-batch of this
stream, so a micro-batch repeated after a failure replaces what it wrote, and `read_online`
gives the current records.

Rows without an id or event time are left out here; `ingest_stream` reports them. With a time to live, Spark
drops rows that come later than `delay` behind the newest, so it should cover the lateness
expected; without one, rows of any age count. A record that is past its time when it comes is not kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.model import API_TIME, IS_DELETED, WRITE_TIME, FeatureGroup
from tidemark.operators.ingest import online_schema, split_valid, write_online
from tidemark.operators.select import stamp

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """RocksDB as the state store of streams started inside."""
    before = {k: spark.conf.get(k, None) for k in ROCKSDB}
    try:
        for k, v in ROCKSDB.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _order(value: Any) -> tuple:
    """Null is least and NaN greatest, as in Spark's order."""
    if value is None:
        return (0, 0)
    if isinstance(value, float) and math.isnan(value):
        return (2, 0)
    return (1, value)


class Newest(StatefulProcessor):
    """The newest row of a record, and a timer for its end."""

    def __init__(self, fg: FeatureGroup, ttl: timedelta | None) -> None:
        schema = online_schema(fg)
        self.schema, self.names = schema, schema.fieldNames()
        first = [fg.event_time, API_TIME, WRITE_TIME]
        self.ranked = [self.names.index(n) for n in [*first, *[n for n in self.names if n not in (*first, fg.record_id)]]]
        self.time = self.names.index(fg.event_time)
        self.instants = [isinstance(f.dataType, T.TimestampType) for f in schema]
        self.emptied = [n not in (fg.record_id, fg.event_time, *first, IS_DELETED) for n in self.names]
        self.ttl = None if ttl is None else ttl // timedelta(milliseconds=1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("newest", self.schema)

    def _rank(self, row: tuple) -> list[tuple]:
        return [_order(row[i]) for i in self.ranked]

    def _plain(self, values: Any) -> tuple:
        """Rows have local times and the state has aware ones; here all are in UTC."""
        return tuple(v.astimezone(timezone.utc) if v is not None and instant else v for v, instant in zip(values, self.instants, strict=True))

    def _end(self, row: tuple) -> int:
        return (row[self.time] - _EPOCH) // timedelta(milliseconds=1) + self.ttl

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        held = self.held.get()  # None if there is none
        before = best = None if held is None else self._plain(held)
        for row in rows:
            came = self._plain([row[n] for n in self.names])
            if best is None or self._rank(came) > self._rank(best):
                best = came
        if best is before:
            return
        if self.ttl is not None:
            if self._end(best) <= timerValues.getCurrentWatermarkInMs():
                return
            if before is not None:
                self.handle.deleteTimer(self._end(before))
            self.handle.registerTimer(self._end(best))
        self.held.update(best)
        yield Row(**dict(zip(self.names, best, strict=True)))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        if not self.held.exists():
            return
        last = self._plain(self.held.get())
        self.held.clear()
        marker = {n: None if gone else v for n, v, gone in zip(self.names, last, self.emptied, strict=True)}
        yield Row(**{**marker, IS_DELETED: True})


#: Rows that a task holds at most while it looks for the newest of each record.
HELD_ROWS = 100_000


def _at_newest(rows: pa.Table, record_id: str, event_time: str) -> pa.Table:
    """The rows at each record's newest time; all of them, as the state decides between equal times."""
    ids = rows.column(record_id).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    times = rows.column(event_time).combine_chunks().cast(pa.int64()).to_numpy(zero_copy_only=False)
    newest = np.full(ids.max(initial=-1) + 1, np.iinfo(np.int64).min)
    np.maximum.at(newest, ids, times)
    return rows.filter(pa.array(times == newest[ids]))


def newest_of_task(batches: Iterator[pa.RecordBatch], record_id: str, event_time: str, most: int = HELD_ROWS) -> Iterator[pa.RecordBatch]:
    """Rows of a task without those older than another row of their record that the task still holds."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= most:
            kept = _at_newest(pa.Table.from_batches(held), record_id, event_time)
            held, n = kept.to_batches(), kept.num_rows
            if n > most // 2:  # many records or many equal times: pass on what there is
                yield from held
                held, n = [], 0
    if held:
        yield from _at_newest(pa.Table.from_batches(held), record_id, event_time).to_batches()


def upsert_stream(
    stream: DataFrame,
    fg: FeatureGroup,
    checkpoint: str,
    online_path: str,
    *,
    ttl: timedelta | None = None,
    delay: str = "1 day",
    written: Column | None = None,
) -> None:
    """Drain a stream into the online table by way of its state; only changed records are written."""
    valid, _ = split_valid(stream, fg)
    rows = stamp(valid, written, written) if WRITE_TIME not in valid.columns else valid
    rows = rows.where(F.col(fg.record_id).isNotNull() & F.col(fg.event_time).isNotNull())
    rows = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in online_schema(fg)])
    if not isinstance(online_schema(fg)[fg.record_id].dataType, (T.StructType, T.ArrayType, T.MapType)):
        record_id, event_time = fg.record_id, fg.event_time
        rows = rows.mapInArrow(lambda batches: newest_of_task(batches, record_id, event_time), online_schema(fg))
    if ttl is not None:
        rows = rows.withWatermark(fg.event_time, delay)
    changes = rows.groupBy(fg.record_id).transformWithState(
        statefulProcessor=Newest(fg, ttl), outputStructType=online_schema(fg), outputMode="Update", timeMode="None" if ttl is None else "EventTime")

    def write(batch: DataFrame, number: int) -> None:
        writer = "state-" + batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        # A record that comes and ends in one micro-batch gives two rows of one time; the marker was written later.
        later = F.when(F.col(IS_DELETED), F.col(WRITE_TIME) + F.expr("interval 1 microsecond")).otherwise(F.col(WRITE_TIME))
        write_online(batch.withColumn(WRITE_TIME, later), fg, online_path, number, writer)

    with rocksdb_state(stream.sparkSession):
        query = changes.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
