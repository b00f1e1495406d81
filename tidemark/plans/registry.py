"""Queries over the benchmark tables, each with the SQL it must agree with."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.fixtures import oracle

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the tables have them."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name; ``sql`` may refer to frames as ``{name}``."""

    def register(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain_times(fn(spark, sf_dir))

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = oracle(sql)
        return run

    return register
