"""Filtered views for cooperating readers. They hide, they do not protect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def row_filter(df: DataFrame, predicate: str | Column) -> DataFrame:
    return df.where(predicate)


def column_filter(df: DataFrame, include: Sequence[str] | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    kept = df if include is None else df.select(*include)
    return kept.drop(*exclude)


def cell_filter(
    df: DataFrame, predicate: str | Column, include: Sequence[str] | None = None, exclude: Sequence[str] = ()
) -> DataFrame:
    """Rows first, then columns, so that the predicate may use a hidden column."""
    return column_filter(row_filter(df, predicate), include, exclude)
