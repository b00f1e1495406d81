"""Lineage as an edge table: from sources over processing and groups to models and endpoints."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import durable, scratch_path

# The kinds of node, from upstream to downstream.
KINDS = ("source", "processing", "feature_group", "training", "model", "endpoint")
EDGE_SCHEMA = "src string, src_kind string, dst string, dst_kind string"


def edges_frame(spark: SparkSession, edges: Iterable[Sequence[str]]) -> DataFrame:
    return spark.createDataFrame([tuple(e) for e in edges], EDGE_SCHEMA)


def training_run_edges(
    spark: SparkSession,
    run: str,
    model: str,
    groups: Sequence[str],
    source: str | None = None,
    processing: str | None = None,
    endpoint: str | None = None,
) -> DataFrame:
    """Edges of one training run: source, processing, groups, run, model and endpoint."""
    edges: list[tuple[str, str, str, str]] = []
    if source and processing:
        edges.append((source, "source", processing, "processing"))
    for group in groups:
        if processing:
            edges.append((processing, "processing", group, "feature_group"))
        edges.append((group, "feature_group", run, "training"))
    edges.append((run, "training", model, "model"))
    if endpoint:
        edges.append((model, "model", endpoint, "endpoint"))
    return edges_frame(spark, edges)


def record_edges(edges: DataFrame, path: str) -> None:
    """Append edges to the edge table; a run recorded twice counts once when read."""
    edges.write.mode("append").parquet(path)


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EDGE_SCHEMA).parquet(path).distinct()


#: Edges followed by one job near the start, and how many such jobs come before paths are doubled.
HOPS, NEAR = 3, 2


def reach(edges: DataFrame, start: str, direction: str, max_depth: int | None = None) -> DataFrame:
    """Nodes within ``max_depth`` steps of a node, by default at any distance, with their kind and smallest depth.

    The first six steps, more than most lineages have, are followed edge by edge from
    the nodes found last, three to a job. The edges are bucketed by their near end once, so only nodes
    move in the steps. What lies deeper is found by path doubling over the edges
    between nodes not reached yet: each round takes paths twice as long as the one before, so
    rounds grow with the logarithm of the depth. Cycles end, as only nearest finds count. Each
    round is written to the shared folder: the next starts from files.
    """
    steps = {
        "down": edges.select(F.col("src").alias("at"), F.col("dst").alias("node"), F.col("dst_kind").alias("kind")),
        "up": edges.select(F.col("dst").alias("at"), F.col("src").alias("node"), F.col("src_kind").alias("kind")),
    }
    if direction == "both":
        hop = steps["down"].unionByName(steps["up"])
    elif direction in steps:
        hop = steps[direction]
    else:
        raise ValueError(f"direction must be 'up', 'down' or 'both', not {direction!r}")
    hop = hop.where((F.col("node") != start) & (F.col("at") != F.col("node")))
    most = float("inf") if max_depth is None else max_depth
    first = hop.where(F.col("at") == start)
    if most < 1 or first.isEmpty():
        return _nothing(hop)
    if most == 1:
        return durable(first.select("node", "kind").distinct().withColumn("depth", F.lit(1)), "reach")
    stored = _bucketed(hop)
    try:
        return _followed(edges.sparkSession.table(stored), start, most)
    finally:
        edges.sparkSession.sql(f"drop table {stored}")  # its files are scratch


def _bucketed(hop: DataFrame) -> str:
    """The edges as a table bucketed by their near end, one sorted file to a bucket."""
    spark = hop.sparkSession
    name, buckets = f"hop_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = hop.repartition(buckets, "at").write.bucketBy(buckets, "at").sortBy("at")
    rows.option("path", scratch_path(spark, "hop")).saveAsTable(name)
    return name


def _followed(hop: DataFrame, start: str, most: float) -> DataFrame:
    found, frontier, depth = None, hop.sparkSession.range(1).select(F.lit(start).alias("node")), 0
    for _ in range(NEAR):
        new, last, far = None, frontier, min(depth + HOPS, most)
        while depth < far:
            depth += 1
            last = hop.join(last.select(F.col("node").alias("at")).distinct(), "at", "left_semi").select("node", "kind").distinct()
            step = last.withColumn("depth", F.lit(depth))
            new = step if new is None else new.unionByName(step)
        if new is None:
            return found
        new = _nearest(new)
        if found is not None:
            new = new.join(found.select("node"), "node", "left_anti")
        new = durable(new.select("node", "kind", "depth"), "reach")
        found = new if found is None else found.unionByName(new)
        frontier = new.where(F.col("depth") == depth).select("node").distinct()
        if frontier.isEmpty():
            return found
    return found if depth >= most else _doubled(hop, found, frontier, depth, most)


def _nothing(hop: DataFrame) -> DataFrame:
    return hop.select("node", "kind", F.lit(0).alias("depth")).limit(0)


def _nearest(rows: DataFrame) -> DataFrame:
    """Each node once per kind, all of them at its least depth."""
    least = rows.groupBy("node", "kind").agg(F.min("depth").alias("depth"))
    return least.withColumn("depth", F.min("depth").over(Window.partitionBy("node")))


def _doubled(hop: DataFrame, found: DataFrame, frontier: DataFrame, depth: int, most: float) -> DataFrame:
    """What lies beyond the frontier. In round k, `paths` are all of exactly 2^k edges, and nodes nearer than that are known."""
    known = found.select("node").distinct()
    beyond = hop.join(known.select(F.col("node").alias("at")).join(frontier.select(F.col("node").alias("at")), "at", "left_anti"), "at", "left_anti")
    paths = durable(beyond.join(known, "node", "left_anti").select("at", "node", "kind").distinct(), "paths")
    near = durable(frontier.select("node", F.lit("").alias("kind"), F.lit(depth).alias("depth")), "reach")  # left out in the end: `found` has them
    length = 1
    while depth + length <= most and not paths.isEmpty():
        ahead = paths.join(near.select(F.col("node").alias("at"), "depth").distinct(), "at").select("node", "kind", (F.col("depth") + length).cast("int").alias("depth"))
        ahead = ahead.join(near.select("node"), "node", "left_anti")
        if most != float("inf"):
            ahead = ahead.where(F.col("depth") <= most)
        new = durable(_nearest(ahead).select("node", "kind", "depth"), "reach")
        if new.isEmpty():
            break
        near = near.unionByName(new)
        then = paths.select(F.col("at").alias("node"), F.col("node").alias("end"), F.col("kind").alias("end_kind"))
        paths = durable(paths.join(then, "node").select("at", F.col("end").alias("node"), F.col("end_kind").alias("kind")).distinct(), "paths")
        length *= 2
    return found.unionByName(near.where(F.col("depth") > depth))


def groups_of_model(edges: DataFrame, model: str, max_depth: int | None = None) -> DataFrame:
    return _of_kind(reach(edges, model, "up", max_depth), "feature_group")


def models_of_group(edges: DataFrame, group: str, max_depth: int | None = None) -> DataFrame:
    return _of_kind(reach(edges, group, "down", max_depth), "model")


def groups_of_source(edges: DataFrame, source: str, max_depth: int | None = None) -> DataFrame:
    return _of_kind(reach(edges, source, "down", max_depth), "feature_group")


def sources_of_group(edges: DataFrame, group: str, max_depth: int | None = None) -> DataFrame:
    return _of_kind(reach(edges, group, "up", max_depth), "source")


def connected(edges: DataFrame, endpoint: str, max_depth: int | None = None) -> DataFrame:
    """Everything upstream of an endpoint and everything downstream of it."""
    up = reach(edges, endpoint, "up", max_depth)
    down = reach(edges, endpoint, "down", max_depth)
    both = up.unionByName(down).groupBy("node", "kind").agg(F.min("depth").alias("depth"))
    return both


def delete_lineage(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges that touch none of the nodes."""
    gone = nodes.select("node").distinct()
    kept = edges.join(gone, edges["src"] == gone["node"], "left_anti")
    return kept.join(gone, kept["dst"] == gone["node"], "left_anti")


def _of_kind(nodes: DataFrame, kind: str) -> DataFrame:
    return nodes.where(F.col("kind") == kind)
