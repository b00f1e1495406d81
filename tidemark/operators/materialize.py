"""Incremental materialisation: each run brings only the history written since the last into the online table.

The mark is the latest write time brought over so far. It is kept beside the
deltas, one small JSON folder per run, written after the run's delta: a run broken off is
repeated by the next one under the same number, which replaces its delta.

A run takes rows written at or after the mark, as more rows of that very time may have come
since; rows brought twice change nothing. Where write times may reach the history out of order, `lag` says
by how much, and each run reaches back that far. The bound is a filter on the write
time, which the scan uses to skip files and row groups: files appended later
have later write times. Rows without a write time can't be told new from old and are an error.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import WRITE_TIME, FeatureGroup
from tidemark.operators.ingest import write_online
from tidemark.operators.latest import time_literal
from tidemark.session import file_system

WRITER = "materialize"
_MARKS = "_marks"  # a leading underscore hides it from readers of the table


@dataclass(frozen=True)
class Mark:
    """The end of a run: its number, the latest write time brought over (microseconds), and the rows the next run finds at least."""

    run: int
    written: int
    lag: int
    rows: int


def last_mark(spark: SparkSession, path: str) -> Mark | None:
    """The mark of the last finished run of a table."""
    folder = f"{path}/{_MARKS}"
    fs, target = file_system(spark, folder)
    if not fs.exists(target):
        return None
    found = [s.getPath() for s in fs.listStatus(target)]
    done = [int(p.getName().split("=")[1]) for p in found if p.getName().startswith("run=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    if not done:
        return None
    row = spark.read.schema("written long, lag long, rows long").json(f"{folder}/run={max(done)}").first()
    return Mark(max(done), row["written"], row["lag"], row["rows"])


def _instant(history: DataFrame, micros: int) -> Column:
    return time_literal(history, WRITE_TIME, F.lit(datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)))


def written_since(history: DataFrame, mark: Mark | None, lag: timedelta = timedelta(0)) -> DataFrame:
    """The rows a run takes: all at first, then those written at or after the mark, less the lag."""
    if mark is None:
        return history
    return history.where(F.col(WRITE_TIME) >= _instant(history, mark.written - lag // timedelta(microseconds=1)))


def materialize_since(spark: SparkSession, history: DataFrame, fg: FeatureGroup, path: str, lag: timedelta = timedelta(0)) -> int:
    """Bring new history into the online table at `path`; returns the rows taken, 0 if nothing is new."""
    mark, back = last_mark(spark, path), lag // timedelta(microseconds=1)
    rows = written_since(history, mark, lag)
    micros = F.unix_micros(F.col(WRITE_TIME).cast("timestamp"))
    count, untimed, latest = rows.agg(F.count(F.lit(1)), F.count_if(micros.isNull()), F.max(micros)).first()
    if untimed:
        raise ValueError(f"{untimed} rows of {fg.name!r} have no {WRITE_TIME}")
    if count == 0 or (mark is not None and (latest, back, count) == (mark.written, mark.lag, mark.rows)):
        return 0
    number = 0 if mark is None else mark.run + 1
    taken = rows.where(F.col(WRITE_TIME) <= _instant(history, latest))  # what comes while this runs is left to the next run
    write_online(taken, fg, path, number, WRITER)
    again = taken.where(F.col(WRITE_TIME) >= _instant(history, latest - back)).count()
    made = spark.range(1).select(F.lit(latest).alias("written"), F.lit(back).alias("lag"), F.lit(again).alias("rows"))
    made.coalesce(1).write.mode("overwrite").json(f"{path}/{_MARKS}/run={number}")
    return count
