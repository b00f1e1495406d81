"""Rows as lists of named text values, and typed rows back from them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import FeatureGroup, feature_type, spark_type


def to_records(df: DataFrame, fg: FeatureGroup) -> DataFrame:
    """One row per record: its id and an array of (name, value, values).

    A list feature fills ``values``, any other ``value``; null features are left out.
    """
    parts = []
    for f in fg.schema.fields:
        is_list = isinstance(f.dataType, T.ArrayType)
        empty_list = F.lit(None).cast("array<string>")
        parts.append(
            F.struct(
                F.lit(f.name).alias("name"),
                F.lit(None).cast("string").alias("value") if is_list else F.col(f.name).cast("string").alias("value"),
                F.col(f.name).cast("array<string>").alias("values") if is_list else empty_list.alias("values"),
            )
        )
    record = F.filter(F.array(*parts), lambda r: r["value"].isNotNull() | r["values"].isNotNull())
    return df.select(F.col(fg.record_id).alias("record_id"), record.alias("record"))


def records_long(records: DataFrame) -> DataFrame:
    """One row per feature of each record; a list value is written as JSON text."""
    exploded = records.select("record_id", F.explode("record").alias("r"))
    value = F.coalesce("r.value", F.to_json("r.values"))
    return exploded.select("record_id", F.col("r.name").alias("feature_name"), value.alias("value_as_string"))


def from_records(records: DataFrame, fg: FeatureGroup, names: Sequence[str] | None = None) -> DataFrame:
    """Typed rows from records: text cast by feature type, absent features null."""
    columns = []
    for f in fg.schema.fields:
        if names is not None and f.name not in names:
            continue
        found = F.get(F.filter("record", _named(f.name)), F.lit(0))
        if isinstance(f.dataType, T.ArrayType):
            columns.append(found["values"].cast(f.dataType).alias(f.name))
        else:
            columns.append(found["value"].try_cast(spark_type(feature_type(f.dataType))).alias(f.name))
    return records.select(*columns)


def _named(name: str) -> Callable[[Column], Column]:
    return lambda r: r["name"] == name


def long_to_rows(long: DataFrame, fg: FeatureGroup) -> DataFrame:
    """Typed rows from the long form: one aggregation per record, no pivot over distinct names."""
    picked = []
    for f in fg.schema.fields:
        value = F.max(F.when(F.col("feature_name") == f.name, F.col("value_as_string")))
        if isinstance(f.dataType, T.ArrayType):
            picked.append(F.from_json(value, "array<string>").cast(f.dataType).alias(f.name))
        else:
            picked.append(value.try_cast(spark_type(feature_type(f.dataType))).alias(f.name))
    return long.groupBy("record_id").agg(*picked).drop("record_id")
