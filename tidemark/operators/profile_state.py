"""Profiles that grow with their table: partial states per partition are stored, and merged for a profile.

`update_states` reads only partitions that are new, or whose files changed since their
state was made, and makes the state of each in one scan: counts, range, mean and
squared deviations of every column, the co-moments of every pair, and a KLL sketch of
the values, whose rank error is fixed by its size however many are merged. `merged_profile`,
`merged_correlation` and `merged_quantiles` read states alone. Moments are merged about the
common mean, so a state's values may lie far from the others' without loss.

A partition is one folder of the table. NaN counts as missing; means, deviations and quantiles
are those of finite values, as in the profiles over rows. The state of a partition that is gone is
no longer counted. States of other columns than asked for are made anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.compact import stored_files
from tidemark.operators.monitor import _prepared
from tidemark.session import durable, file_system
from tidemark.sources.versions import list_folders

SKETCH_K = 400  # a normalised rank error below one percent
_STATE = "folder string, print string, columns string, rows long, moments array<struct<name string, n long, low double, high double, finite long, mean double, m2 double, sketch binary>>, pairs array<struct<name string, other string, n long, mean_x double, mean_y double, c double, x2 double, y2 double>>"


def fingerprints(spark: SparkSession, table: str) -> DataFrame:
    """folder and print of every partition: which files it holds, of what size, from the listing alone."""
    files = stored_files(spark, table).select("folder", F.xxhash64("file", "bytes").alias("h"))
    return files.groupBy("folder").agg(F.concat_ws("-", F.count(F.lit(1)), F.bit_xor("h"), F.sum(F.pmod("h", F.lit(1 << 31)))).alias("print"))


def read_states(spark: SparkSession, table: str, states: str, columns: Sequence[str]) -> DataFrame:
    """The states that hold for the table as it is."""
    fs, target = file_system(spark, states)
    found = spark.read.schema(_STATE).parquet(states) if fs.exists(target) and list_folders(spark, states) else spark.createDataFrame([], _STATE)
    now = fingerprints(spark, table)
    one = found.where(F.col("columns") == ",".join(columns)).join(now, ["folder", "print"], "left_semi")
    return one.dropDuplicates(["folder"])  # two runs at once make the same state


def update_states(spark: SparkSession, table: str, states: str, columns: Sequence[str]) -> int:
    """Make the states that are missing; returns how many partitions were read."""
    columns = list(columns)
    missing = durable(fingerprints(spark, table).join(read_states(spark, table, states, columns), ["folder", "print"], "left_anti"), "missing")
    wanted = [(r["folder"], r["print"]) for r in missing.toLocalIterator()]  # one entry to a partition
    if not wanted:
        return 0
    rows = spark.read.option("recursiveFileLookup", True).parquet(*[f for f, _ in wanted])
    made = partial_states(rows, columns).join(missing, "folder").withColumn("columns", F.lit(",".join(columns)))
    made.select("folder", "print", "columns", "rows", "moments", "pairs").write.parquet(f"{states}/run={uuid.uuid4().hex}")
    return len(wanted)


def partial_states(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One state per folder of files, by one aggregation."""
    folder = F.url_decode(F.replace(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", ""), F.lit("+"), F.lit("%2B")))
    named = rows.select(F.regexp_replace(folder, "^file:/+", "file:/").alias("folder"), *columns)
    ready = _prepared(named, columns, "folder")
    n = range(len(columns))
    moments = [
        F.struct(
            F.lit(columns[i]).alias("name"), F.count(f"v{i}").alias("n"), F.min(f"v{i}").alias("low"), F.max(f"v{i}").alias("high"),
            F.count(f"f{i}").alias("finite"), F.avg(f"f{i}").alias("mean"), (F.var_pop(f"f{i}") * F.count(f"f{i}")).alias("m2"),
            F.kll_sketch_agg_double(f"f{i}", F.lit(SKETCH_K)).alias("sketch"))
        for i in n
    ]
    pairs = []
    for i, j in combinations(n, 2):
        both = F.col(f"f{i}").isNotNull() & F.col(f"f{j}").isNotNull()
        x, y = F.when(both, F.col(f"f{i}")), F.when(both, F.col(f"f{j}"))
        pairs.append(F.struct(
            F.lit(columns[i]).alias("name"), F.lit(columns[j]).alias("other"), F.count(x).alias("n"), F.avg(x).alias("mean_x"), F.avg(y).alias("mean_y"),
            (F.covar_pop(x, y) * F.count(x)).alias("c"), (F.var_pop(x) * F.count(x)).alias("x2"), (F.var_pop(y) * F.count(y)).alias("y2")))
    none = F.from_json(F.lit("[]"), _STATE.split("pairs ")[1])
    return ready.groupBy("folder").agg(F.count(F.lit(1)).alias("rows"), F.array(*moments).alias("moments"), (F.array(*pairs) if pairs else F.first(none)).alias("pairs"))


def merged_profile(states: DataFrame) -> DataFrame:
    """What `profile_numeric` gives over all rows, from states."""
    each = states.select("rows", F.explode("moments").alias("m")).select("rows", "m.*")
    centre = each.groupBy("name").agg((F.sum(F.col("finite") * F.col("mean")) / F.sum("finite")).alias("centre"))
    about = F.col("m2") + F.col("finite") * F.pow(F.col("mean") - F.col("centre"), 2)
    return each.join(centre, "name").groupBy("name").agg(
        F.sum("n").alias("value_count"), (F.sum("rows") - F.sum("n")).alias("missing_count"), F.min("low").alias("minimum"), F.max("high").alias("maximum"),
        F.first("centre").alias("mean"), F.when(F.sum("finite") > 1, F.sqrt(F.sum(about) / (F.sum("finite") - 1))).alias("standard_deviation"))


def merged_correlation(states: DataFrame) -> DataFrame:
    """The correlation of every pair of columns, from states."""
    each = states.select(F.explode("pairs").alias("p")).select("p.*").where("n > 0")
    weighted = lambda c: F.sum(F.col("n") * F.col(c)) / F.sum("n")
    centre = each.groupBy("name", "other").agg(weighted("mean_x").alias("at_x"), weighted("mean_y").alias("at_y"))
    dx, dy = F.col("mean_x") - F.col("at_x"), F.col("mean_y") - F.col("at_y")
    sums = each.join(centre, ["name", "other"]).groupBy("name", "other").agg(
        F.sum(F.col("c") + F.col("n") * dx * dy).alias("c"), F.sum(F.col("x2") + F.col("n") * dx * dx).alias("x2"), F.sum(F.col("y2") + F.col("n") * dy * dy).alias("y2"))
    return sums.select("name", "other", F.when((F.col("x2") > 0) & (F.col("y2") > 0), F.col("c") / F.sqrt(F.col("x2") * F.col("y2"))).alias("correlation"))


def merged_quantiles(states: DataFrame, shares: Sequence[float]) -> DataFrame:
    """name, share, value: quantiles of the finite values, within the sketch's rank error."""
    each = states.select(F.explode("moments").alias("m")).where("m.finite > 0").select("m.name", "m.sketch")
    whole = each.groupBy("name").agg(F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch"))
    found = [F.struct(F.lit(float(s)).alias("share"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(s))).alias("value")) for s in shares]
    return whole.select("name", F.inline(F.array(*found)))
