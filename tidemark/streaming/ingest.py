"""Incremental ingestion: each new file is ingested once, then current values are updated.

A run drains what has arrived and stops, so a scheduler can start it as often as
wanted. The checkpoint remembers files and names the query; each micro-batch writes to
folders named by the query and its number, with overwrite, so a batch repeated after a failure
changes nothing, and streams with other checkpoints never touch each other's rows.
Late rows always reach the history; event-time order keeps them from replacing
newer current values, so no watermark is used and nothing is dropped as late.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.model import FeatureGroup
from tidemark.operators.ingest import split_valid, write_online
from tidemark.operators.latest import as_time
from tidemark.operators.select import stamp
from tidemark.sources.files import partition_values


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "csv", files_per_batch: int | None = None
) -> DataFrame:
    """New files below a folder, as a stream."""
    reader = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", f"*.{fmt}")
    if fmt == "csv":
        reader = reader.option("header", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def ingest_stream(
    stream: DataFrame,
    fg: FeatureGroup,
    checkpoint: str,
    *,
    offline_path: str | None = None,
    online_path: str | None = None,
    failed_path: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    written: Column | None = None,
    grain: str = "day",
) -> None:
    """Drain a stream into the history, the online table or both; rejected rows go to ``failed_path``."""

    def write(batch: DataFrame, number: int) -> None:
        writer = "stream-" + batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch = batch.persist()  # used by up to three writes of this batch
        try:
            rows = transform(batch) if transform else batch
            valid, failed = split_valid(rows, fg)
            stamped = stamp(valid, written, written)
            if offline_path:
                values = partition_values(as_time(stamped, fg.event_time), grain)
                placed = stamped.withColumns(values).hint("rebalance", *values)
                placed.write.mode("overwrite").partitionBy(*values).parquet(f"{offline_path}/batch={writer}.{number}")
            if online_path:
                write_online(stamped, fg, online_path, number, writer)
            if failed_path:
                failed.write.mode("overwrite").json(f"{failed_path}/batch={writer}.{number}")
        finally:
            batch.unpersist()

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_ingested(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The history written by ``ingest_stream``."""
    rows = spark.read.option("basePath", path).parquet(path).drop("batch")
    return rows if columns is None else rows.select(*columns)
