"""Stored layouts that lookups by record id use: bucketed tables, and files clustered by id with Bloom filters."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.model import FeatureGroup

#: At most so many ids go into a filter that the scan sees; more become a join.
LISTED_IDS = 1_000
#: Longer lists reach Parquet as their range only (spark.sql.parquet.pushdown.inFilterThreshold).
PUSHED_IN = 10


def write_bucketed(df: DataFrame, fg: FeatureGroup, table: str, path: str, buckets: int) -> None:
    """A history as a table bucketed by record id and sorted by id and event time, one file to a bucket.

    `buckets` should give files of a few hundred MB; a task of a later join reads one.
    """
    rows = df.repartition(buckets, fg.record_id)
    writer = rows.write.bucketBy(buckets, fg.record_id).sortBy(fg.record_id, fg.event_time)
    writer.mode("overwrite").option("path", path).saveAsTable(table)


def bucket_count(df: DataFrame) -> int | None:
    """The number of buckets of the stored table that a frame reads, None if it reads no such table alone."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    if leaves.size() != 1 or leaves.apply(0).getClass().getSimpleName() != "LogicalRelation":
        return None
    relation = leaves.apply(0).relation()
    spec = relation.bucketSpec() if hasattr(relation, "bucketSpec") else None
    return spec.get().numBuckets() if spec is not None and spec.isDefined() else None


def write_clustered(df: DataFrame, fg: FeatureGroup, path: str, files: int, mode: str = "append", row_group: int = 128 << 20, distinct: int = 1_000_000, partition_by: Sequence[str] = ()) -> None:
    """Files that each hold a range of record ids, sorted, with a Bloom filter of the ids per row group.

    Least and greatest ids tell most files apart; the filters tell the rest, and all of those
    that were appended over the same range.
    """
    rows = df.repartitionByRange(files, *partition_by, fg.record_id).sortWithinPartitions(*partition_by, fg.record_id)
    writer = rows.write.mode(mode).option("parquet.block.size", row_group)
    writer = writer.option(f"parquet.bloom.filter.enabled#{fg.record_id}", "true")
    writer = writer.option(f"parquet.bloom.filter.expected.ndv#{fg.record_id}", distinct)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def of_ids(df: DataFrame, key: str, ids: DataFrame | Sequence[Any], listed: int = LISTED_IDS) -> DataFrame:
    """Rows of some record ids; null matches nothing.

    A short list reaches the scan, which skips files and row groups without the
    ids by their ranges and Bloom filters; a long one is a join. Both give the same rows.
    """
    if not isinstance(ids, DataFrame):
        kind = df.schema[key].dataType.simpleString()
        ids = df.sparkSession.createDataFrame([(i,) for i in ids], f"`{key}` {kind}")
    wanted = ids.select(F.col(f"`{ids.columns[0]}`").alias(key)).where(F.col(f"`{key}`").isNotNull()).distinct()
    found = sorted(r[0] for r in wanted.limit(listed + 1).collect())
    if len(found) > listed:
        return df.join(wanted, key, "left_semi").select(*df.columns)
    return df.where(one_of(F.col(f"`{key}`"), found)) if found else df.limit(0)


def one_of(column: Column, values: Sequence[Any]) -> Column:
    """Whether a column has one of some values, in lists short enough for Parquet to be asked for each value."""
    tests = [column.isin(list(values[i : i + PUSHED_IN])) for i in range(0, len(values), PUSHED_IN)]
    while len(tests) > 1:  # a balanced tree, as a chain would be too deep
        tests = [a | b for a, b in zip(tests[::2], tests[1::2])] + (tests[-1:] if len(tests) % 2 else [])
    return tests[0]
