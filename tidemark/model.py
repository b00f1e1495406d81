"""Feature groups: typed tables with a record id, an event time and history."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

WRITE_TIME = "write_time"
API_TIME = "api_invocation_time"
IS_DELETED = "is_deleted"
SYSTEM_COLUMNS = (WRITE_TIME, API_TIME, IS_DELETED)
PARTITION_COLUMNS = ("year", "month", "day", "hour")

INTEGRAL, FRACTIONAL, STRING = "Integral", "Fractional", "String"

_INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL_TYPES = (T.FloatType, T.DoubleType, T.DecimalType)

# Declared type names accepted besides the three feature types themselves.
_DECLARED = {"float": FRACTIONAL, "double": FRACTIONAL, "long": INTEGRAL, "int": INTEGRAL}


def feature_type(dtype: T.DataType) -> str:
    """The scalar feature type of a Spark type (of its elements, for a list)."""
    if isinstance(dtype, T.ArrayType):
        dtype = dtype.elementType
    if isinstance(dtype, _INTEGRAL_TYPES):
        return INTEGRAL
    if isinstance(dtype, _FRACTIONAL_TYPES):
        return FRACTIONAL
    return STRING


def spark_type(kind: str, collection: str | None = None) -> T.DataType:
    scalar = {INTEGRAL: T.LongType(), FRACTIONAL: T.DoubleType(), STRING: T.StringType()}[kind]
    return T.ArrayType(scalar) if collection == "List" else scalar


@dataclass(frozen=True)
class FeatureGroup:
    """Definition of a feature group; the data itself is always a DataFrame."""

    name: str
    record_id: str
    event_time: str
    schema: T.StructType
    description: str = ""
    tags: Mapping[str, str] = field(default_factory=dict)
    online: bool = True
    location: str | None = None

    def __post_init__(self) -> None:
        names = self.schema.fieldNames()
        for role, column in (("record id", self.record_id), ("event time", self.event_time)):
            if column not in names:
                raise ValueError(f"{self.name}: {role} column {column!r} is not among {names}")

    @classmethod
    def from_frame(cls, name: str, df: DataFrame, record_id: str, event_time: str, **extra) -> FeatureGroup:
        """Infer the definition from a frame, leaving system and partition columns out."""
        hidden = {*SYSTEM_COLUMNS, *PARTITION_COLUMNS}
        fields = [f for f in df.schema.fields if f.name not in hidden]
        return cls(name, record_id, event_time, T.StructType(fields), **extra)

    @classmethod
    def declared(
        cls, name: str, columns: Sequence[tuple[str, str]], record_id: str, event_time: str, **extra
    ) -> FeatureGroup:
        """Build from (name, declared type) pairs: float, long, anything else is String."""
        fields = []
        for column, declared in columns:
            kind = declared if declared in (INTEGRAL, FRACTIONAL, STRING) else _DECLARED.get(declared, STRING)
            fields.append(T.StructField(column, spark_type(kind)))
        return cls(name, record_id, event_time, T.StructType(fields), **extra)

    @property
    def names(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def core_features(self) -> list[str]:
        """Every feature except the record id and the event time."""
        return [n for n in self.names if n not in (self.record_id, self.event_time)]

    def definitions(self) -> list[dict[str, str | None]]:
        return [
            {
                "feature_name": f.name,
                "feature_type": feature_type(f.dataType),
                "collection_type": "List" if isinstance(f.dataType, T.ArrayType) else None,
            }
            for f in self.schema.fields
        ]

    def describe(self) -> dict:
        return {
            "name": self.name,
            "record_id": self.record_id,
            "event_time": self.event_time,
            "description": self.description,
            "tags": dict(self.tags),
            "online": self.online,
            "location": self.location,
            "features": self.definitions(),
        }

    def add_feature(self, name: str, dtype: T.DataType) -> FeatureGroup:
        """Additive evolution: older rows read the new feature as null."""
        if name in self.names:
            raise ValueError(f"{self.name}: feature {name!r} exists already")
        return replace(self, schema=T.StructType([*self.schema.fields, T.StructField(name, dtype)]))

    def tag(self, **tags: str) -> FeatureGroup:
        """Set tags; an existing tag is overwritten."""
        return replace(self, tags={**self.tags, **tags})


def definitions_frame(spark: SparkSession, groups: Iterable[FeatureGroup]) -> DataFrame:
    rows = [(g.name, d["feature_name"], d["feature_type"], d["collection_type"]) for g in groups for d in g.definitions()]
    return spark.createDataFrame(
        rows, "feature_group string, feature_name string, feature_type string, collection_type string"
    )


def parse_features(
    features: Sequence[str], groups: Mapping[str, FeatureGroup]
) -> list[tuple[FeatureGroup, str]]:
    """Resolve ``'group:feature'`` and ``'group:*'`` in the order requested."""
    resolved: list[tuple[FeatureGroup, str]] = []
    for item in features:
        group, sep, feature = item.partition(":")
        if not sep or not group or not feature:
            raise ValueError(f"feature {item!r} is not of the form 'group:feature'")
        if group not in groups:
            raise ValueError(f"unknown feature group {group!r} in {item!r}")
        fg = groups[group]
        wanted = fg.core_features if feature == "*" else [feature]
        for name in wanted:
            if name not in fg.names:
                raise ValueError(f"feature group {group!r} has no feature {name!r}")
            if (fg, name) not in resolved:
                resolved.append((fg, name))
    return resolved


def feature_names(groups: Iterable[FeatureGroup], exclude: Sequence[str] = ()) -> list[tuple[str, str]]:
    """(group, feature) pairs of several groups minus an exclusion list."""
    return [(g.name, n) for g in groups for n in g.names if n not in set(exclude)]
