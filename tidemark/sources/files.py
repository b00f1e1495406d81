"""Reading and writing frames: CSV, the offline store layout, datasets, file statistics."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tidemark.functions.scalar import year_month
from tidemark.model import PARTITION_COLUMNS, FeatureGroup
from tidemark.operators.latest import as_time
from tidemark.operators.select import stamp

# CSV keeps microseconds; Spark's default would cut them to milliseconds.
CSV_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

GRAINS = PARTITION_COLUMNS  # year, month, day, hour: a layout uses a leading part of them


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("header", header).csv(path)


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with every column as text, to be cast later."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def read_prefix(
    spark: SparkSession, path: str, schema: T.StructType | str, suffix: str = ".csv", header: bool = True
) -> DataFrame:
    """All files below a folder whose name ends in ``suffix``; none give an empty frame."""
    empty = spark.createDataFrame([], schema)
    reader = spark.read.schema(empty.schema).option("header", header)
    reader = reader.option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", True)
    try:
        return reader.csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty
        raise


def rows_to_df(spark: SparkSession, rows: Sequence[Sequence[Any]], schema: T.StructType | str | list[str]) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def partition_values(moment: Column, grain: str = "hour") -> dict[str, Column]:
    parts = {"year": F.year(moment), "month": F.month(moment), "day": F.day(moment), "hour": F.hour(moment)}
    return {name: parts[name] for name in GRAINS[: GRAINS.index(grain) + 1]}


def write_offline(
    df: DataFrame,
    fg: FeatureGroup,
    path: str,
    *,
    grain: str = "hour",
    written: Column | None = None,
    invoked: Column | None = None,
    stamped: bool = False,
    mode: str = "append",
) -> None:
    """Append to the history, partitioned by event time.

    System columns are added unless the frame has them already (``stamped``).
    The rebalance hint gathers each partition's rows into few files and lets AQE
    split a partition that is too large for one task.
    """
    rows = df if stamped else stamp(df, written, invoked)
    values = partition_values(as_time(rows, fg.event_time), grain)
    rows = rows.withColumns(values)
    rows.hint("rebalance", *values).write.mode(mode).partitionBy(*values).parquet(path)


def read_offline(
    spark: SparkSession,
    source: str,
    *,
    table_format: str = "parquet",
    start: datetime | None = None,
    end: datetime | None = None,
    grain: str = "hour",
    schema: T.StructType | str | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """The history of a group: a Parquet folder, or a catalog table in another format.

    After features were added, give the ``schema``, or ``merge_schema`` to have
    the footers of all files read for it.
    ``start`` and ``end`` prune partitions only: rows of the partitions at either
    end still need an event-time filter.
    """
    if table_format.lower() != "parquet":
        df = spark.table(source)
    else:
        reader = spark.read.option("mergeSchema", merge_schema)
        df = (reader.schema(schema) if schema is not None else reader).parquet(source)
    if start is not None:
        df = df.where(_bound(start, grain, lower=True))
    if end is not None:
        df = df.where(_bound(end, grain, lower=False))
    return df


def _bound(moment: datetime, grain: str, lower: bool) -> Column:
    """Partition columns on or after (before) a moment, compared part by part."""
    out = None
    for part in reversed(GRAINS[: GRAINS.index(grain) + 1]):
        column, value = F.col(part), getattr(moment, part)
        beyond = column > value if lower else column < value
        inside = column >= value if lower else column <= value
        out = inside if out is None else beyond | ((column == value) & out)
    return out


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", **options: Any) -> None:
    """A query result as files: parquet, orc, json, csv; avro and text where available."""
    defaults = CSV_TIMES if fmt == "csv" else {}
    df.write.format(fmt).options(**{**defaults, **options}).save(path)


def write_csv(df: DataFrame, path: str, header: bool = False, sep: str = ",") -> None:
    df.write.options(header=header, sep=sep, **CSV_TIMES).csv(path)


def write_by_month(df: DataFrame, time: str, path: str, fmt: str = "csv") -> None:
    """One folder per month, named ``year_month=2020-1``; each row is in exactly one."""
    rows = df.withColumn("year_month", year_month(F.col(time)))
    writer = rows.hint("rebalance", "year_month").write.partitionBy("year_month")
    writer.options(header=True, **CSV_TIMES).format(fmt).save(path)


def spread(df: DataFrame, factor: int = 3) -> DataFrame:
    """Even partitions, a few per core, for a sink outside Spark; AQE sizes all other writes."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism * factor)


def sample_file(df: DataFrame, n: int = 10) -> DataFrame:
    """The first rows of one of the files a frame is read from, with its partition columns."""
    first = df.select(F.input_file_name().alias("file")).where("file <> ''").limit(1).collect()
    if not first:
        return df.limit(0)
    file = first[0]["file"]
    # the table's folder ends before the first folder named by a partition value
    base = re.split(r"/[^/=]+=", file)[0] if "=" in file else file.rsplit("/", 1)[0]
    return df.sparkSession.read.schema(df.schema).option("basePath", base).parquet(file).limit(n)


def partition_stats(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes per partition folder, from the file listing alone."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )
    folder = F.regexp_replace("path", "/[^/]*$", "")
    partition = F.regexp_extract(folder, r"((?:[^/=]+=[^/]+)(?:/[^/=]+=[^/]+)*)$", 1)
    return files.groupBy(partition.alias("partition")).agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("length").alias("total_size")
    )
