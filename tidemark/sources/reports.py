"""Profile reports: nested JSON per run, flattened, consolidated and written as CSV."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Nested statistics that the full and the short table leave out.
DROPPED_ALWAYS = ("mostCommonValues",)
DROPPED_IN_SHORT = (
    "valueDistribution",
    "zScoreOutliersSample",
    "minimumValues",
    "maximumValues",
    "zScoreDistribution",
)


def write_report(profile: DataFrame, path: str, group: str, written_on: Any) -> None:
    """One JSON report of a profile with one row per column (column ``name``).

    A report has one row per profiled column, so it is one small file.
    """
    stats = F.struct(*[F.col(f"`{c}`").alias(c) for c in profile.columns])
    report = profile.agg(F.sort_array(F.collect_list(stats)).alias("columns")).withColumn(
        "writtenOn", F.date_format(F.lit(written_on).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    report.coalesce(1).write.mode("append").json(f"{path}/{group}")


def read_reports(spark: SparkSession, path: str, group: str, after: Any = None) -> DataFrame:
    """One row per report and column, with the report's file and time, ordered by time."""
    reader = spark.read.option("multiLine", True).option("pathGlobFilter", "*.json")
    raw = reader.json(f"{path}/{group}").withColumn("report_file", F.input_file_name())
    rows = raw.select(
        F.explode("columns").alias("c"),
        F.try_to_timestamp("writtenOn").alias("written_on"),
        F.regexp_extract("report_file", r"([^/]+)$", 1).alias("report_file"),
    ).select("c.*", "written_on", "report_file")
    rows = rows.drop(*DROPPED_ALWAYS)
    if after is not None:
        rows = rows.where(F.col("written_on") > F.lit(after).cast("timestamp"))
    return rows.orderBy("written_on", "name")


def read_reports_variant(spark: SparkSession, path: str, group: str, after: Any = None) -> DataFrame:
    """The same for reports whose statistics differ by run, or have another type in some.

    Reports are parsed to VARIANT. The columns are all statistics that any report has, each of
    the type that fits all its values: whole and other numbers become doubles; lists, objects, and
    statistics of several types stay VARIANT. What a report doesn't have is null, and a file that is no report is
    left out. Only the names and types of the statistics come to the driver.
    """
    files = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(f"{path}/{group}")
    raw = files.select(F.try_parse_json("value").alias("v"), F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1).alias("report_file"))
    rows = raw.select(
        F.explode(F.try_variant_get("v", "$.columns", "array<variant>")).alias("c"),
        F.try_to_timestamp(F.try_variant_get("v", "$.writtenOn", "string")).alias("written_on"), "report_file")
    if after is not None:
        rows = rows.where(F.col("written_on") > F.lit(after).cast("timestamp"))
    fields = rows.select(F.explode(F.try_variant_get("c", "$", "map<string, variant>")).alias("name", "value"))
    kinds = {r["name"]: r["kind"] for r in fields.groupBy("name").agg(F.schema_of_variant_agg("value").alias("kind")).orderBy("name").collect()}
    kept = [k for k in kinds if k not in DROPPED_ALWAYS]
    values = [F.try_variant_get("c", f'$["{k}"]', _VARIANT_TYPES.get(kinds[k].split("(")[0], "variant")).alias(k) for k in kept]
    return rows.select(*values, "written_on", "report_file").orderBy("written_on", *(["name"] if "name" in kept else []))


#: Types that a statistic is read as; all others stay VARIANT.
_VARIANT_TYPES = {"BIGINT": "double", "DECIMAL": "double", "DOUBLE": "double", "FLOAT": "double", "STRING": "string", "BOOLEAN": "boolean", "VOID": "string"}


def consolidate_reports(reports: DataFrame, path: str, group: str) -> tuple[DataFrame, DataFrame]:
    """Write the full and the short table as ``;`` separated CSV and return both.

    CSV holds no nested values, so they are written as JSON text.
    """
    short = reports.drop(*DROPPED_IN_SHORT)
    for name, df in (("full", reports), ("short", short)):
        flat = df.select(
            *[
                F.to_json(f"`{f.name}`").alias(f.name) if f.dataType.typeName() in ("array", "struct", "map", "variant") else F.col(f"`{f.name}`").alias(f.name)
                for f in df.schema.fields
            ]
        )
        flat.write.option("sep", ";").option("header", True).csv(f"{path}/{group}-{name}")
    return reports, short


def feature_series(reports: DataFrame, feature: str, statistics: list[str]) -> DataFrame:
    """One feature's statistics over time, each with its change since the previous run.

    The rows are the runs of one feature: one per report.
    """
    rows = reports.where(F.col("name") == feature).select("written_on", "name", *statistics)
    w = Window.partitionBy("name").orderBy("written_on")
    changes = {f"{s}_change": F.col(s) - F.lag(s).over(w) for s in statistics}
    return rows.withColumns(changes)
