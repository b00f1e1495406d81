"""Token-id files: raw id payloads with a minimal perfect hash index by document key.

A dataset is a folder of numbered shards in key order, each two files:

* ``ids-NNNNN.bin``: the ids of its documents one after the other, as unsigned
  little-endian integers of 2 bytes where the vocabulary fits, else 4;
* ``ids-NNNNN.idx``: per slot of the index a 32-bit fingerprint of the key, the
  first id and the number of ids, and the levels of the hash.

The hash gives each of n keys its own slot of 0..n-1: at each level the keys
that meet no other at their bit keep it, the others go to the next level. A
lookup reads one bit per level and one slot, so its time doesn't depend on n; the
fingerprint tells unknown keys (but one in four thousand million). A key that repeats
gets a number within its key, so every row can be found.

Rows are range-partitioned by key, so a shard holds a run of keys and a third of
all rows under one key would share a shard but still stream through it. A task
streams its rows and holds only the index of its shard. Files are written under
another name and then moved, so a task that runs again does no harm.

Null text is an empty document (its end id alone); null keys come first. An
empty table gives shards without documents.
"""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import pieces, table, texts
from tidemark.llm.encoding import encoder

_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def key_hashes(keys: list, numbers: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash and a 32-bit fingerprint for each key and its number among equals."""
    wide = [xxhash.xxh3_128_intdigest(f"{n}:{k!r}") for k, n in zip(keys, numbers, strict=True)]
    return np.array([w & (1 << 64) - 1 for w in wide], np.uint64), np.array([w >> 96 for w in wide], np.uint32)


class PerfectHash:
    """Slots 0..n-1 for n distinct 64-bit keys, about three bits each."""

    def __init__(self, sizes: list[int], bits: np.ndarray) -> None:
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        words = bits.view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        x = (keys ^ np.uint64((level + 1) * _MIX[1] & (1 << 64) - 1)) * np.uint64(_MIX[0])
        x ^= x >> np.uint64(29)
        x *= np.uint64(_MIX[1])
        x ^= x >> np.uint64(32)
        return (x % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        if len(np.unique(keys)) != len(keys):
            raise ValueError("keys must differ")
        sizes, levels = [], []
        while len(keys):
            size = -(-2 * len(keys) // 64) * 64
            at = cls._place(keys, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            sizes.append(size)
            keys = keys[~alone[at]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, np.uint8))

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where no level has its bit."""
        slots = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        words = self.bits.view(np.uint64)
        for level, size in enumerate(self.sizes):
            if not len(todo):
                break
            bit = self.starts[level] + self._place(keys[todo], level, size)
            word, shift = words[bit >> 6], (bit & 63).astype(np.uint64)
            hit = (word >> shift & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
            slots[todo[hit]] = (self.before[bit >> 6] + below)[hit]
            todo = todo[~hit]
        return slots


class Shard:
    """One shard opened for keyed reads."""

    def __init__(self, folder: str, number: int) -> None:
        self.fs, root = pafs.FileSystem.from_uri(folder)
        self.path = f"{root}/ids-{number:05d}"
        with self.fs.open_input_stream(f"{self.path}.idx") as f:
            parts = np.load(io.BytesIO(f.read()))
            self.hash = PerfectHash(parts["sizes"].tolist(), parts["bits"])
            self.prints, self.starts, self.counts, self.width = parts["prints"], parts["starts"], parts["counts"], int(parts["width"])
        self.payload = self.fs.open_input_file(f"{self.path}.bin")

    def find(self, keys: list, numbers: list[int] | None = None) -> list[tuple[int, int] | None]:
        """First id and number of ids of each key, None where the key isn't stored."""
        if not keys:
            return []
        hashes, prints = key_hashes(keys, numbers or [0] * len(keys))
        slots = self.hash.lookup(hashes)
        known = slots >= 0
        known[known] = self.prints[slots[known]] == prints[known]
        return [(int(self.starts[s]), int(self.counts[s])) if ok else None for s, ok in zip(slots, known, strict=True)]

    def read(self, start: int, count: int) -> np.ndarray:
        self.payload.seek(start * self.width)
        return np.frombuffer(self.payload.read(count * self.width), f"<u{self.width}").astype("<u4")

    def close(self) -> None:
        self.payload.close()


MANIFEST = "shard int, docs long, ids long, size long"


def write_ids(df: DataFrame, folder: str, path: str, key: str = "doc_id", text: str = "text", end_id: int = 1, shards: int | None = None) -> DataFrame:
    """Encode whole texts and write the dataset; one manifest row per shard, with the ids before it."""
    spark = df.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = (
        df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
        .repartitionByRange(shards, "key")
        .sortWithinPartitions("key", "text")
    )
    kind = sorted_rows.schema["key"].dataType
    schema = T.StructType([*T._parse_datatype_string(MANIFEST).fields, T.StructField("first", kind), T.StructField("last", kind)])
    _make_folder(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        width = 2 if max(words.vocabulary, end_id + 1) <= 1 << 16 else 4
        number = TaskContext.get().partitionId()
        fs, root = pafs.FileSystem.from_uri(folder)
        target = f"{root}/ids-{number:05d}"
        mine = f"{root}/_{number:05d}-{uuid.uuid4().hex}"
        prints, hashes, counts = [], [], []
        first = last = None
        equal, started, schema_key = 0, False, pa.null()
        with fs.open_output_stream(f"{mine}.bin") as out:
            for batch in pieces(batches, "text"):
                keys = batch.column("key").to_pylist()
                schema_key = batch.schema.field("key").type
                numbers = []
                for k in keys:
                    equal = equal + 1 if started and k == last else 0
                    first = first if started else k
                    started, last = True, k
                    numbers.append(equal)
                ids = [d + end for d in words.encode(texts(batch.column("text")))]
                out.write(np.frombuffer(b"".join(ids), "<u4").astype(f"<u{width}").tobytes())
                h, p = key_hashes(keys, numbers)
                hashes.append(h)
                prints.append(p)
                counts.extend(len(d) // 4 for d in ids)
        lengths = np.array(counts, np.int64)
        starts = np.cumsum(lengths) - lengths
        all_hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        index = PerfectHash.build(all_hashes)
        slots = index.lookup(all_hashes)
        by_slot = np.empty(len(slots), np.int64)
        by_slot[slots] = np.arange(len(slots))
        packed = io.BytesIO()
        all_prints = np.concatenate(prints) if prints else np.zeros(0, np.uint32)
        np.savez(packed, sizes=np.array(index.sizes, np.int64), bits=index.bits, prints=all_prints[by_slot], starts=starts[by_slot], counts=lengths[by_slot], width=width)
        with fs.open_output_stream(f"{mine}.idx") as out:
            out.write(packed.getvalue())
        fs.move(f"{mine}.bin", f"{target}.bin")
        fs.move(f"{mine}.idx", f"{target}.idx")
        if len(lengths):
            yield table(
                pa.schema([("shard", pa.int32()), ("docs", pa.int64()), ("ids", pa.int64()), ("size", pa.int64()), ("first", schema_key), ("last", schema_key)]),
                {"shard": [number], "docs": [len(lengths)], "ids": [int(lengths.sum())], "size": [int(lengths.sum()) * width], "first": [first], "last": [last]},
            )

    rows = sorted(sorted_rows.mapInArrow(write, schema).collect(), key=lambda r: r["shard"])  # a row per shard
    before, out = 0, []
    for r in rows:
        out.append((r["shard"], r["docs"], r["ids"], r["first"], r["last"], before))
        before += r["ids"]
    fields = [T.StructField("shard", T.IntegerType()), T.StructField("docs", T.LongType()), T.StructField("ids", T.LongType()), T.StructField("first", kind), T.StructField("last", kind), T.StructField("before", T.LongType())]
    return spark.createDataFrame(out, T.StructType(fields))


def _make_folder(folder: str) -> None:
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)


def read_ids(keys: DataFrame, folder: str, manifest: DataFrame, key: str = "doc_id") -> DataFrame:
    """Look every key up in the files: the key, start, n_tokens and ids_crc32 of what is stored.

    Keys that repeat give one row for each stored document of the key; keys that
    aren't stored give nothing.
    """
    spark: SparkSession = keys.sparkSession
    shards = [(r["shard"], r["first"], r["last"], r["before"]) for r in manifest.collect()]  # a row per shard
    kind = keys.schema[key].dataType
    wanted = keys.groupBy(F.col(f"`{key}`").alias("key")).agg(F.count(F.lit(1)).alias("times"))
    schema = T.StructType([T.StructField("key", kind), *T._parse_datatype_string("start long, n_tokens long, ids_crc32 long").fields])
    routed = T.StructType([T.StructField("key", kind), T.StructField("times", T.LongType()), T.StructField("shard", T.IntegerType())])

    def order(value: object) -> tuple:
        return (value is not None, value)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import bisect

        firsts = [order(s[1]) for s in shards]
        for batch in batches:
            values = batch.column("key").to_pylist()
            at = [bisect.bisect_right(firsts, order(v)) - 1 for v in values]
            number = pa.array([shards[i][0] if i >= 0 else None for i in at], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("times"), number], names=["key", "times", "shard"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = {s[0]: s[3] for s in shards}
        opened: Shard | None = None
        number = None
        for batch in batches:
            names, times, where = (batch.column(c).to_pylist() for c in ("key", "times", "shard"))
            found: dict[str, list] = {"key": [], "start": [], "n_tokens": [], "ids_crc32": []}
            i = 0
            while i < len(names):
                j = i
                while j < len(names) and where[j] == where[i]:
                    j += 1
                if where[i] != number:
                    if opened:
                        opened.close()
                    number = where[i]
                    opened = Shard(folder, number)
                wanted_keys = [k for k, n in zip(names[i:j], times[i:j], strict=True) for _ in range(n)]
                numbers = [m for n in times[i:j] for m in range(n)]
                for k, at in zip(wanted_keys, opened.find(wanted_keys, numbers), strict=True):
                    if at:
                        found["key"].append(k)
                        found["start"].append(before[number] + at[0])
                        found["n_tokens"].append(at[1])
                        found["ids_crc32"].append(zlib.crc32(opened.read(*at).tobytes()))
                i = j
            yield table(pa.schema([batch.schema.field("key"), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]), found)
        if opened:
            opened.close()

    if not shards:
        return spark.createDataFrame([], schema).withColumnRenamed("key", key)
    ready = wanted.mapInArrow(route, routed).where("shard is not null").repartition(len(shards), "shard").sortWithinPartitions("shard", "key")
    return ready.mapInArrow(read, schema).withColumnRenamed("key", key)
