"""Connected components of an edge table that may be of any size, by joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import durable


def components(edges: DataFrame) -> DataFrame:
    """node and label, its component's least node, for every node of the edges (a, b).

    Alternates two steps until nothing changes: every node's larger neighbours go
    to its least neighbour, then the smaller ones do. Rounds grow with the
    logarithm of the longest path. A round is written to the shared folder.
    """
    now = durable(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(down, "a")
        small = moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(down.select("a", F.col("m").alias("b"))).distinct()
        now = durable(small, "edges")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
