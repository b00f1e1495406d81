from datetime import datetime, timedelta

from tidemark.model import FeatureGroup

DAY0 = datetime(2024, 1, 1)


def at(hours: float) -> datetime:
    return DAY0 + timedelta(hours=hours)


HISTORY = "id long, event_time timestamp, x double, write_time timestamp, api_invocation_time timestamp, is_deleted boolean"


def history(spark, rows):
    """Rows of (id, event hour, x, write hour, api hour, deleted)."""
    data = [(i, None if e is None else at(e), x, at(w), at(a), d) for i, e, x, w, a, d in rows]
    df = spark.createDataFrame(data, HISTORY)
    return df, FeatureGroup.from_frame("g", df, "id", "event_time")


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
