"""Similarity join of documents on word shingles: MinHash banding, then exact Jaccard on full sets.

1. Each text becomes its set of shingles (`shingles.shingle_set`) and a hash per
   band. Texts with equal sets are one distinct text from here on, with a count, so a
   third of all rows being copies costs one row per task.
2. Band hashes are shuffled; each bucket of two or more links its members to its
   least one, and components of these links hold every candidate pair.
3. Components are cut into blocks of about `BLOCK` distinct texts, and each pair of blocks of a component is
   a unit of work of bounded size: it builds the full sets and compares all of
   its pairs exactly. Pairs aren't emitted, only each text's number of links
   and a spanning forest. So a large group spreads over many tasks, and no candidate is left out.
4. Components of the verified links are the classes.

The number of bands and rows is chosen so that a pair exactly at the threshold
meets with the target probability. Texts are compared as `decontaminate.split_words`
splits them (in lower case, without marks). Distinct sets are named by 64-bit hashes.

Texts without words (null, empty, only marks) have no shingles: each is alone,
without links. Rows repeated in full are copies, linked to each other. A class is named by its least
key; null keys don't name a class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import pieces, raw, table
from tidemark.llm.graph import components
from tidemark.llm.shingles import MinHash, bands_for, shingle_set
from tidemark.llm.substring_dedup import marked
from tidemark.session import durable

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
BLOCK = 96
#: Cells of a block's matrix of texts and shingles at most; more shingles go in turns.
_CELLS = 4_000_000


def signatures(docs: DataFrame, words: int, minhash: MinHash) -> DataFrame:
    """Per row: key, r1, r2, the set's name (null without words) and the hashes of its bands."""
    schema = T.StructType([T.StructField("key", docs.schema["key"].dataType), *T._parse_datatype_string("r1 long, r2 int, name long, bands array<long>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            names, bands = [], []
            for text in raw(batch.column("text")):
                hashes = shingle_set(text, words)
                names.append(xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63) if len(hashes) else None)
                bands.append(minhash.band_hashes(hashes) if len(hashes) else None)
            yield table(
                pa.schema([batch.schema.field("key"), ("r1", pa.int64()), ("r2", pa.int32()), ("name", pa.int64()), ("bands", pa.list_(pa.int64()))]),
                {"key": batch.column("key"), "r1": batch.column("r1"), "r2": batch.column("r2"), "name": names, "bands": bands})

    return docs.mapInArrow(run, schema)


def similar_pairs(sets: list[np.ndarray], others: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Which sets of the first list are similar to which of the second (or, if None, to each other)."""
    right = sets if others is None else others
    both = [*sets, *(others or [])]
    sizes = np.array([len(s) for s in both], np.int64)
    rows = np.repeat(np.arange(len(both)), sizes)
    _, column = np.unique(np.concatenate(both), return_inverse=True)
    shared = np.zeros((len(sets), len(right)), np.float64)
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    step = max(1, _CELLS // len(both))
    for first in range(0, int(column[-1]) + 1, step):
        a, b = np.searchsorted(column, [first, first + step])
        part = np.zeros((len(both), step), np.float32)
        part[rows[a:b], column[a:b] - first] = 1
        shared += part[: len(sets)] @ (part[: len(sets)] if others is None else part[len(sets) :]).T
    total = sizes[: len(sets), None] + sizes[None, -len(right) :] - shared
    out = shared >= threshold * total - 1e-9
    if others is None:
        np.fill_diagonal(out, False)
    return out


def _forest(links: np.ndarray, left: list[int], right: list[int]) -> list[tuple[int, int]]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i, j in np.argwhere(links).tolist():
        a, b = root(left[i]), root(right[j])
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(x, root(x)) for x in parent if root(x) != x]


def join(documents: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """Per row: key, r1, r2 (the row's marks, see `marked`), class_id (least key of its class), class_mark, n_links, n_class."""
    docs = marked(documents, key, text)
    minhash = MinHash(*bands_for(threshold, recall))
    found = durable(signatures(docs, words, minhash), "signatures")
    sets = durable(
        found.where("name is not null").groupBy("name").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("key").isNull().alias("none"), "key", "r1", "r2")).alias("row")), "sets")
    # which text of a set gives the bands doesn't matter; copies send theirs once per task
    banded = found.where("name is not null").select("name", F.explode("bands").alias("bucket")).groupBy("name", "bucket").agg(F.lit(1).alias("one")).select("name", "bucket")
    banded = durable(banded, "bands")
    buckets = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("b")).where("n > 1").select("bucket", "b")
    candidates = components(banded.join(buckets, "bucket").select(F.col("name").alias("a"), "b"))
    candidates = durable(candidates.select(F.col("node").alias("name"), "label"), "candidates")
    sizes = candidates.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    members = candidates.join(sizes, "label").join(sets.select("name", "n", "row.r1", "row.r2"), "name") \
        .withColumn("block", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"))
    with_text = docs.select("r1", "r2", "text").join(members, ["r1", "r2"])
    units = with_text.select(
        "label", "name", "n", "block", "text",
        F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("block", o).alias("i"), F.greatest("block", o).alias("j")))).alias("unit"),
    ).select("label", "unit.i", "unit.j", "name", "n", "block", "text")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, int, np.ndarray]] = {}
        unit = None
        out: dict[str, list] = {"a": [], "b": [], "links": []}

        def close() -> None:
            if len(held) < 2:
                return
            names = list(held)
            if unit[1] == unit[2]:
                left, right = names, names
                links = similar_pairs([held[x][2] for x in left], None, threshold)
            else:
                left, right = [x for x in names if held[x][0] == unit[1]], [x for x in names if held[x][0] == unit[2]]
                if not left or not right:
                    return
                links = similar_pairs([held[x][2] for x in left], [held[x][2] for x in right], threshold)
            for side, grid, others in ((left, links, right), (right, links.T, left)):
                if side is others and grid is not links:
                    continue  # within one block every pair is seen from both ends already
                counts = grid @ np.array([held[x][1] for x in others], np.int64)
                for x, c in zip(side, counts.tolist(), strict=True):
                    if c:
                        out["a"].append(x)
                        out["b"].append(None)
                        out["links"].append(c)
            for a, b in _forest(links, left, right):
                out["a"].append(a)
                out["b"].append(b)
                out["links"].append(0)

        schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])
        for batch in batches:
            for small in pieces(iter([batch]), "text"):
                columns = [small.column(c).to_pylist() for c in ("label", "i", "j", "name", "n", "block")]
                for label, i, j, name, n, part, text in zip(*columns, raw(small.column("text")), strict=True):
                    if unit != (label, i, j):
                        close()
                        held, unit = {}, (label, i, j)
                    if name not in held:
                        held[name] = (part, n, shingle_set(text, words))
                if len(out["a"]) > 10_000:
                    yield table(schema, out)
                    out = {"a": [], "b": [], "links": []}
        close()
        yield table(schema, out)

    verified = durable(units.repartition("label", "i", "j").sortWithinPartitions("label", "i", "j").mapInArrow(verify, "a long, b long, links long"), "links")
    links = verified.groupBy(F.col("a").alias("name")).agg(F.sum("links").alias("links"))
    classes = components(verified.where("b is not null").select("a", "b")).select(F.col("node").alias("name"), "label")
    named = sets.join(classes, "name", "left").join(links, "name", "left").withColumn("label", F.coalesce("label", "name"))
    per_class = named.groupBy("label").agg(F.sum("n").alias("n_class"), F.min("row").alias("first"))
    by_set = named.join(per_class, "label").select(
        "name", F.col("first.key").alias("class_id"), "n_class", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.struct("first.r1", "first.r2").alias("class_mark"))
    mark = F.struct("r1", "r2")
    return found.join(by_set, "name", "left").select(
        F.col("key").alias(key), "r1", "r2", F.when(F.col("name").isNull(), F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_mark", mark).alias("class_mark"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("n_class", F.lit(1)).cast("long").alias("n_class"))


def keep_one(documents: DataFrame, key: str = "doc_id", text: str = "text", **how: object) -> DataFrame:
    """All columns of one row of each class, the one of least key; rows without words all stay."""
    kept = join(documents, key, text, **how).where(F.col("class_mark") == F.struct("r1", "r2")).groupBy("r1", "r2").agg(F.max("n_links").alias("n_links"))
    t = F.col(f"`{text}`").cast("string")
    rows = documents.withColumns({"__mark_1": F.xxhash64(F.col(f"`{key}`"), t), "__mark_2": F.hash(t, F.col(f"`{key}`"))})
    one = rows.join(kept.select(F.col("r1").alias("__mark_1"), F.col("r2").alias("__mark_2")), ["__mark_1", "__mark_2"])
    return one.dropDuplicates(["__mark_1", "__mark_2"]).drop("__mark_1", "__mark_2").select(*documents.columns)
