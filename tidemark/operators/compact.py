"""Compaction by bin packing: only the small files of a partition are rewritten, several into one.

Files under `small` share of the target are packed within their partition, largest first, each
into the first bin with room. A bin of one file is left alone, and so is every file
that is large enough, by name and time. All bins are written by one job, a bin
to a task, below a folder beside the partitions that readers don't see; then
each new file takes the place of the old ones.

Which files a bin replaces is written down before the first is touched. A run that
breaks off before all bins are written changes nothing; one that breaks off
later is finished by the next run, whose first act this is. Between a new file's coming and the old ones'
going a reader may see rows twice, as with every compaction in place.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import delete_path, durable, file_system
from tidemark.sources.versions import TARGET_BYTES, list_folders

_WORK = "_binpack-"  # a leading underscore hides it from readers
SMALL = 0.75


def first_fit(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each size: largest first, each into the first bin with room."""
    bins: list[int] = []
    place = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fit = next((b for b, used in enumerate(bins) if used + sizes[i] <= capacity), len(bins))
        if fit == len(bins):
            bins.append(0)
        bins[fit] += sizes[i]
        place[i] = fit
    return place


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """folder, file, name (as rows read from it carry it) and bytes of the Parquet files of a table, from the listing alone."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
    found = found.where(~F.col("path").contains(f"/{_WORK}"))
    return found.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder"), F.col("path").alias("file"), F.col("_metadata.file_path").alias("name"), F.col("length").alias("bytes"))


def pack_files(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, small: float = SMALL) -> DataFrame:
    """folder, bin, file, name, bytes of the files worth merging: bins of two files or more."""
    files = stored_files(spark, path).where(F.col("bytes") < int(small * target_bytes))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("file", ignore_index=True)
        rows["bin"] = first_fit(rows["bytes"].tolist(), target_bytes)
        return rows[rows.groupby("bin")["file"].transform("size") > 1][["folder", "bin", "file", "name", "bytes"]]

    return files.groupBy("folder").applyInPandas(pack, "folder string, bin long, file string, name string, bytes long")


def compact_binpack(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, small: float = SMALL, at_once: int = 10_000) -> int:
    """Merge the small files of each partition into files near the target; returns the number of files merged away.

    A table with more files to merge than `at_once` takes several jobs, so the driver holds no more names than that.
    """
    _finish(spark, path)
    packed = durable(pack_files(spark, path, target_bytes, small), "bins")
    bins = packed.groupBy("folder", "bin").agg(F.collect_list(F.struct("file", "name")).alias("files"))
    merged, held = 0, []
    for row in bins.toLocalIterator():
        held.append((row["folder"], row["files"]))
        if sum(len(files) for _, files in held) >= at_once:
            merged += _rewrite(spark, path, held)
            held = []
    return merged + (_rewrite(spark, path, held) if held else 0)


def _rewrite(spark: SparkSession, path: str, bins: list[tuple[str, list]]) -> int:
    """Merge the files of each bin into one, in one job."""
    work = f"{path}/{_WORK}{uuid.uuid4().hex}"
    old = [f["file"] for _, files in bins for f in files]
    # The files' own rows and columns; partition columns stay in the folder names.
    read = spark.read.option("recursiveFileLookup", True)
    rows = read.schema(read.option("mergeSchema", True).parquet(*old).schema).parquet(*old).withColumn("__file", F.col("_metadata.file_path"))
    named = spark.createDataFrame([(f["name"], n) for n, (_, files) in enumerate(bins) for f in files], "__file string, __bin long")
    rows.join(F.broadcast(named), "__file").drop("__file").repartition("__bin").write.partitionBy("__bin").parquet(f"{work}/new")
    plan = spark.createDataFrame([(n, folder, [f["file"] for f in files]) for n, (folder, files) in enumerate(bins)], "__bin long, folder string, files array<string>")
    plan.coalesce(1).write.json(f"{work}/plan")  # from here on the run will be finished, by the next one if need be
    _finish(spark, path)
    return len(old) - len(bins)


def _finish(spark: SparkSession, path: str) -> None:
    """Put the files of planned runs into place; drop what was never planned."""
    for work in [f for f in list_folders(spark, path) if f.rsplit("/", 1)[1].startswith(_WORK)]:
        fs, done = file_system(spark, f"{work}/plan/_SUCCESS")
        if fs.exists(done):
            for row in spark.read.schema("__bin long, folder string, files array<string>").json(f"{work}/plan").toLocalIterator():
                _replace(spark, f"{work}/new/__bin={row['__bin']}", row["folder"], row["files"])
        delete_path(spark, work)


def _replace(spark: SparkSession, made: str, folder: str, old: list[str]) -> None:
    """Move a bin's new files into the folder, then delete what they replace; either may have happened already."""
    fs, source = file_system(spark, made)
    as_path = spark._jvm.org.apache.hadoop.fs.Path
    if fs.exists(source):
        for status in fs.listStatus(source):
            name = status.getPath().getName()
            if not name.startswith(("_", ".")) and not fs.rename(status.getPath(), as_path(f"{folder}/{name}")):
                raise OSError(f"{status.getPath()} can't be moved to {folder}")
    for file in old:
        fs.delete(as_path(file), False)
