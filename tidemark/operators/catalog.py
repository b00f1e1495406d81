"""The feature catalog as a table: definitions, descriptions, parameters, search."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import FeatureGroup

CATALOG_SCHEMA = (
    "feature_group string, feature_name string, feature_type string, "
    "description string, params map<string,string>, created_at timestamp, "
    "group_description string, tags map<string,string>"
)


def catalog_frame(spark: SparkSession, groups: list[FeatureGroup], created_at: datetime) -> DataFrame:
    rows = [
        (g.name, d["feature_name"], d["feature_type"], None, {}, created_at, g.description, dict(g.tags))
        for g in groups for d in g.definitions()
    ]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def describe_feature(
    catalog: DataFrame, group: str, feature: str, description: str | None = None, params: Mapping[str, str] | None = None
) -> DataFrame:
    """Set a description and add or overwrite key/value parameters of one feature."""
    here = (F.col("feature_group") == group) & (F.col("feature_name") == feature)
    if description is not None:
        catalog = catalog.withColumn("description", F.when(here, F.lit(description)).otherwise(F.col("description")))
    if params:
        added = F.create_map(*[F.lit(x) for pair in params.items() for x in pair])
        old = F.map_filter("params", lambda k, _: ~k.isin(list(params)))
        catalog = catalog.withColumn("params", F.when(here, F.map_concat(old, added)).otherwise(F.col("params")))
    return catalog


def tag_group(catalog: DataFrame, group: str, tags: Mapping[str, str], description: str | None = None) -> DataFrame:
    """Add or overwrite a group's tags, and its description if one is given."""
    here = F.col("feature_group") == group
    added = F.create_map(*[F.lit(x) for pair in tags.items() for x in pair]).cast("map<string,string>")
    old = F.map_filter(F.coalesce("tags", F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin(list(tags)))
    out = catalog.withColumn("tags", F.when(here, F.map_concat(old, added)).otherwise(F.col("tags")))
    if description is not None:
        out = out.withColumn("group_description", F.when(here, F.lit(description)).otherwise(F.col("group_description")))
    return out


def group_tags(catalog: DataFrame) -> DataFrame:
    """(feature_group, tag, value) of every group."""
    return catalog.select("feature_group", F.explode("tags").alias("tag", "value")).distinct()


def search(
    catalog: DataFrame,
    text: str | None = None,
    scope: str = "all",
    created_from: Any = None,
    created_to: Any = None,
    param: tuple[str, str] | None = None,
) -> DataFrame:
    """Features whose name, description or parameters contain the text, in any case."""
    out = catalog
    if text is not None:
        where = _matches(text)
        if scope not in where and scope != "all":
            raise ValueError(f"scope must be 'all' or one of {sorted(where)}, not {scope!r}")
        found = where.get(scope)
        if found is None:
            found = where["name"] | where["description"] | where["parameters"]
        out = out.where(found)
    if created_from is not None:
        out = out.where(F.col("created_at") >= F.lit(created_from))
    if created_to is not None:
        out = out.where(F.col("created_at") <= F.lit(created_to))
    if param is not None:
        out = out.where(F.try_element_at("params", F.lit(param[0])) == param[1])
    return out


def _matches(text: str) -> dict[str, Column]:
    wanted = text.lower()

    def contains(c: Column) -> Column:
        return F.coalesce(F.lower(c).contains(wanted), F.lit(False))

    either = F.exists(F.map_keys("params"), contains) | F.exists(F.map_values("params"), contains)
    return {
        "name": contains(F.col("feature_name")),
        "description": contains(F.col("description")),
        "parameters": F.coalesce(either, F.lit(False)),
    }


def list_groups(catalog: DataFrame, contains: str | None = None) -> DataFrame:
    """Groups whose name holds the text, with their number of features."""
    rows = catalog if contains is None else catalog.where(F.lower("feature_group").contains(contains.lower()))
    return rows.groupBy("feature_group").agg(F.count(F.lit(1)).alias("feature_count"))
