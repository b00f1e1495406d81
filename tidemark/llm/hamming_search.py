"""Approximate nearest neighbours by cosine: multi-index hashing over learned binary codes.

* *Codes.* On a bounded sample of distinct vectors (`SAMPLE`) the principal axes
  are rotated so that the signs along them keep as much as possible (iterative
  quantisation). The signs of a vector are its code, 64 bits at most.
* *Radius.* The Hamming radius is the one within which `reach` of the
  sample's true neighbours lie; neighbours in the whole table are nearer than in a sample.
* *Index.* Codes are split into substrings, each with its own table of values. If
  two codes differ in at most r bits, one of m substrings differs in at most
  r // m, so looking each table up for near values finds every code within the radius;
  the whole codes are then compared, and the floats of what remains are ranked
  in double precision.
* *Spark.* The index is dealt into shards of about `SHARD` vectors and the queries into blocks; each
  pair of shard and block is a unit that returns its best k per query, which
  are merged by a grouped limit. Equal vectors are one entry with their k + 1 smallest ids, and
  equal queries are searched once, so a vector that a third of all rows hold costs one entry.

A unit with fewer than k + 1 codes in the radius looks at all of its codes, so no
query gets fewer than k results while there are candidates.

Vectors that are null, zero, of another length than most, or that hold null or
non-finite components take no part, nor do rows without an id. Rows with one id and different
vectors are separate candidates; a query never returns its own id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import durable

SAMPLE = 4096
SHARD = 2048
BLOCK = 1024
REACH = 0.99
_TURNS = 30


@dataclass
class Codes:
    axes: np.ndarray
    radius: int
    bits: int

    def encode(self, unit: np.ndarray) -> np.ndarray:
        signs = np.zeros((len(unit), 64), np.uint8)
        signs[:, : self.bits] = unit @ self.axes > 0
        return np.packbits(signs, axis=1, bitorder="little").view(np.uint64).ravel()


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def learn_codes(sample: np.ndarray, k: int, reach: float = REACH) -> Codes:
    """Rotation and radius from a sample of vectors, one per row."""
    unit = _unit(sample)
    bits = min(64, unit.shape[1])
    _, axes = np.linalg.eigh(unit.T @ unit)
    axes = axes[:, ::-1][:, :bits]
    projected = unit @ axes
    rotation = np.linalg.qr(np.random.default_rng(5).normal(size=(bits, bits)))[0]
    for _ in range(_TURNS):
        left, _, right = np.linalg.svd(np.where(projected @ rotation > 0, 1.0, -1.0).T @ projected)
        rotation = (left @ right).T
    codes = Codes(axes @ rotation, bits, bits)
    code = codes.encode(unit)
    some = np.arange(min(len(unit), 512))
    cosine = unit[some] @ unit.T
    cosine[some, some] = -np.inf
    near = np.argsort(-cosine, 1)[:, : min(k, max(0, len(unit) - 1))]
    if near.size:
        codes.radius = int(np.quantile(np.bitwise_count(code[some][:, None] ^ code[near]), reach, method="higher"))
    return codes


class SubstringIndex:
    """Tables of the substrings' values of a shard's codes."""

    def __init__(self, codes: np.ndarray, bits: int, parts: int = 4) -> None:
        self.codes = codes
        self.width = -(-bits // parts)
        self.tables = []
        for j in range(-(-bits // self.width)):
            values, which = np.unique(self._part(codes, j), return_inverse=True)
            self.tables.append((values, which))

    def _part(self, codes: np.ndarray, j: int) -> np.ndarray:
        return codes >> np.uint64(j * self.width) & np.uint64((1 << self.width) - 1)

    def within(self, queries: np.ndarray, radius: int) -> np.ndarray:
        """Which codes (columns) lie within the radius of which queries (rows)."""
        near, extra = divmod(radius, len(self.tables))
        found = np.zeros((len(queries), len(self.codes)), bool)
        for j, (values, which) in enumerate(self.tables):
            # the first extra + 1 substrings may differ by `near`, the others by one less
            most = near if j <= extra else near - 1
            if most >= 0:
                probe = np.bitwise_count(self._part(queries, j)[:, None] ^ values[None, :]) <= most
                found |= probe[:, which]
        rows, columns = np.nonzero(found)
        far = np.bitwise_count(queries[rows] ^ self.codes[columns]) > radius
        found[rows[far], columns[far]] = False
        return found


def valid_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    v = F.col(f"`{vector}`").cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.select(F.col(f"`{key}`").cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(~bad & F.exists("v", lambda x: x != 0))


def search(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 5, shard: int = SHARD, block: int = BLOCK, reach: float = REACH) -> DataFrame:
    """query_id, rank, vec_id, score: for each id divisible by `every`, its k nearest of all other ids."""
    good = valid_vectors(rows, key, vector)
    w = Window.partitionBy("v").orderBy("id")
    entries = durable(
        good.distinct().withColumn("n", F.row_number().over(w)).where(F.col("n") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")), "entries")
    spark = rows.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    sample = entries.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()  # a bounded sample
    lengths = [len(r["v"]) for r in sample]
    if not lengths:
        return spark.createDataFrame([], out)
    length = max(sorted(set(lengths)), key=lengths.count)
    codes = learn_codes(np.array([r["v"] for r in sample if len(r["v"]) == length]), k, reach)
    entries = entries.where(F.size("v") == length)
    asked = good.where((F.size("v") == length) & (F.col("id") % every == 0)).distinct()
    queries = durable(asked.groupBy("v").agg(F.min("id").alias("query")), "queries")
    shards = max(1, -(-entries.count() // shard))
    blocks = max(1, -(-queries.count() // block))
    cells = entries.select(
        F.pmod(F.xxhash64("v"), F.lit(shards)).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")).alias("block"),
        F.lit(None).cast("long").alias("query"), "ids", "v",
    ).unionByName(queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<long>")).alias("shard"), F.pmod(F.xxhash64("v"), F.lit(blocks)).alias("block"),
        "query", F.lit(None).cast("array<long>").alias("ids"), "v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell: tuple | None = None
        held: list[pa.RecordBatch] = []
        for batch in batches:
            place = list(zip(batch.column("shard").to_pylist(), batch.column("block").to_pylist(), strict=True))
            start = 0
            for i in range(1, len(place) + 1):
                if i == len(place) or place[i] != place[start]:
                    if cell is not None and place[start] != cell:
                        yield _search_cell(held, codes, k)
                        held = []
                    cell = place[start]
                    held.append(batch.slice(start, i - start))
                    start = i
        if held:
            yield _search_cell(held, codes, k)

    found = cells.repartition("shard", "block").sortWithinPartitions("shard", "block").mapInArrow(run, "query long, ids array<long>, score double")
    best = found.select("query", F.explode("ids").alias("vec_id"), F.col("score").alias("s")).withColumn(
        "at", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("s"), "vec_id"))).where(F.col("at") <= k + 1)
    ranked = best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("at", "vec_id", "s"))).alias("found"))  # k + 1 each
    members = asked.join(queries, "v").select(F.col("id").alias("query_id"), "query").distinct()
    mine = members.join(ranked, "query").select(
        "query_id", F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("found"))
    return mine.select("query_id", F.posexplode("found").alias("at", "x")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.s").alias("score"))


def _search_cell(held: list[pa.RecordBatch], codes: Codes, k: int) -> pa.RecordBatch:
    """The best entries of one shard for each query of one block, enough for k other ids."""
    rows = pa.Table.from_batches(held)
    values = np.array(rows.column("v").to_pylist(), np.float64)
    asked = np.array([q is not None for q in rows.column("query").to_pylist()])
    ids = [x for x in rows.column("ids").to_pylist() if x is not None]
    names = [q for q in rows.column("query").to_pylist() if q is not None]
    out: dict[str, list] = {"query": [], "ids": [], "score": []}
    if names and ids:
        entries, queries = values[~asked], values[asked]
        unit, query_unit = _unit(entries), _unit(queries)
        code, query_code = codes.encode(unit), codes.encode(query_unit)
        index = SubstringIndex(code, codes.bits)
        for a in range(0, len(names), 256):
            near = index.within(query_code[a : a + 256], codes.radius)
            near[near.sum(1) < k + 1] = True
            cosine = np.where(near, query_unit[a : a + 256] @ unit.T, -np.inf)
            keep = min(k + 1, len(ids))
            least = -np.partition(-cosine, keep - 1, axis=1)[:, keep - 1]
            for i, j in np.argwhere((cosine >= least[:, None] - 1e-12) & near).tolist():
                q, v = queries[a + i], entries[j]
                out["query"].append(names[a + i])
                out["ids"].append(ids[j])
                out["score"].append(_cosine(q, v))
    return pa.RecordBatch.from_arrays([pa.array(out["query"], pa.int64()), pa.array(out["ids"], pa.list_(pa.int64())), pa.array(out["score"], pa.float64())], names=["query", "ids", "score"])


def _cosine(a: np.ndarray, b: np.ndarray) -> float:
    if not (1e-100 < np.abs(a).max() < 1e100 and 1e-100 < np.abs(b).max() < 1e100):  # squares would leave the range
        a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return float(a @ b) / float(np.sqrt(a @ a) * np.sqrt(b @ b)) + 0.0
