"""A training-corpus pipeline over `documents`: five stages, each written as Parquet and read again.

Each stage takes what its predecessor kept, with all columns; its decisions take
effect in the rows or texts that it returns, and the last returns the pieces of the packed windows.
Texts that a stage changes get their new length in n_chars. A stage keeps rows with null or
empty texts as the operator it calls says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard_join, quality, substring_dedup
from tidemark.llm.packing import pack
from tidemark.llm.queries import table, vocabulary
from tidemark.session import scratch_path

#: Bytes of a passage that counts as repeated: about fifty words.
REPEAT_BYTES = 250


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are similar to 0.8 or more."""
    return jaccard_join.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur more than once."""
    return _measured(substring_dedup.remove_repeats_from_texts(docs, length=REPEAT_BYTES))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of benchmark windows."""
    return _measured(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document's tokens in windows of at most 4096."""
    return pack(docs, vocabulary("word_bpe_49k.json"))


def _measured(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_passages),
    ("packing", packing),
]
#: SQL can't express the trained classifier, so the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
