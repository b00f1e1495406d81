"""Scalar column functions, all JVM-side expressions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Escapes for characters that tags may not hold.
TAG_ESCAPES = {"$": "_D_", "?": "_Q_", "&": "_A_", "#": "_H_"}

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def tag_escape(c: Column) -> Column:
    for raw, escaped in TAG_ESCAPES.items():
        c = F.replace(c, F.lit(raw), F.lit(escaped))
    return c


def tag_unescape(c: Column) -> Column:
    """Inverse of tag_escape, unless the text held an escape such as ``_D_`` already."""
    for raw, escaped in TAG_ESCAPES.items():
        c = F.replace(c, F.lit(escaped), F.lit(raw))
    return c


def md5_hex(c: Column) -> Column:
    return F.md5(c)


def iso8601(ts: Column) -> Column:
    """ISO-8601 UTC text with milliseconds; the session time zone must be UTC."""
    return F.date_format(ts, ISO_MILLIS)


def epoch_to_iso(seconds: Column) -> Column:
    """Epoch seconds as ISO-8601 UTC text; the session time zone must be UTC."""
    return F.date_format(F.timestamp_seconds(seconds), ISO_SECONDS)


def parse_ts(c: Column) -> Column:
    """Text to timestamp; text that is none becomes null."""
    return F.try_to_timestamp(c)


def days_since(c: Column, as_of: date | datetime | str) -> Column:
    """Whole days from the column's date to ``as_of``."""
    return F.datediff(F.lit(as_of).cast("date"), F.to_date(c))


def year_month(c: Column) -> Column:
    """'2020-1' for January 2020: the month is not padded."""
    return F.concat_ws("-", F.year(c), F.month(c))


def prefixed_id(prefix: str, n: Column) -> Column:
    return F.concat(F.lit(prefix), n.cast("string"))


def day_list(share: Column, key: Column, days: int = 31, scale: float = 10.0) -> Column:
    """``int(scale * share)`` day numbers as strings, drawn by a hash of the key."""
    count = F.floor(share * scale).cast("int")
    steps = F.when(count > 0, F.sequence(F.lit(1), count)).when(
        share.isNotNull(), F.array().cast("array<int>")
    )
    return F.transform(steps, lambda i: F.pmod(key * 31 + i * 17, F.lit(days)).cast("string"))
