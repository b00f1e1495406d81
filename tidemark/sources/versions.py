"""Maintenance of stored tables: erasure, content checks, a catalog's own procedures.

Tables with versions belong in a table-format catalog, whose procedures
``call_procedure`` runs; partition folders are compacted and erased in
``operators.ingest``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import IS_DELETED, FeatureGroup
from tidemark.session import delete_path, file_system

TARGET_BYTES = 128 << 20


def hard_delete(history: DataFrame, fg: FeatureGroup) -> DataFrame:
    """All rows of records without a delete marker, whenever the marker was written."""
    marked = history.where(F.col(IS_DELETED)).select(fg.record_id).distinct()
    return history.join(marked, fg.record_id, "left_anti").select(*history.columns)


def content_hash(df: DataFrame) -> DataFrame:
    """Row count and an order-free hash of the content."""
    row = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.bit_xor(row).alias("xor_hash"),
        F.sum(F.pmod(row, F.lit(1_000_003))).alias("sum_hash"),
    )


def call_procedure(spark: SparkSession, catalog: str, procedure: str, **arguments: str) -> DataFrame:
    """Run a table-format maintenance procedure, e.g. ``rewrite_data_files``, in its own catalog."""
    given = ", ".join(f"{name} => '{value}'" for name, value in arguments.items())
    return spark.sql(f"CALL {catalog}.system.{procedure}({given})")


def drop_data(spark: SparkSession, path: str, confirm: bool = False) -> None:
    """Delete a feature group's files; refuses without ``confirm=True``."""
    if not confirm:
        raise ValueError("dropping data needs confirm=True")
    delete_path(spark, path)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    fs, target = file_system(spark, path)
    return [str(s.getPath()) for s in fs.listStatus(target) if s.isDirectory()] if fs.exists(target) else []
