"""Packing documents into token windows by the sum-of-squares rule.

Every document is cut into full windows and a rest shorter than a window; rests
are whole pieces, never cut further. A shard packs its rests online: the level
array counts the partially filled windows at each fill level, and a rest goes
where the sum of the squared counts becomes least (a new window counts as level
0; equal choices take the fullest window). Full windows leave the array.

Shards are cut by a hash of the document, about `SHARD_DOCS` documents each
however large the table is, and packed independently; only lengths and
checksums are shuffled, never ids. A window left open at the end is padded,
unless its fill is a power of two, which batches take as it is.

Null text is an empty document (one end id). Repeated rows and null keys are
packed like any others. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import pieces, table, texts
from tidemark.llm.encoding import encoder

WINDOW = 4096
#: Documents that a shard packs on average.
SHARD_DOCS = 8192

PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class LevelArray:
    """Counts of open windows by fill, and which windows they are."""

    def __init__(self, window: int) -> None:
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]
        self.made = 0

    def place(self, size: int) -> tuple[int, int]:
        """The window and offset for a piece of 1 to `window` ids."""
        top = self.window - size
        now = self.counts[: top + 1]
        after = self.counts[size : self.window + 1]
        # moving a window from level h to h + size changes the squares by this; full windows aren't counted
        change = 2 * after - 2 * now + 2
        change[top] = 1 - 2 * now[top]
        change[0] = 2 * after[0] + 1 if size < self.window else 0
        change[1:][now[1:] == 0] = np.iinfo(np.int64).max
        level = top - int(change[::-1].argmin())
        if level == 0:
            which, self.made = self.made, self.made + 1
        else:
            which = self.open[level].pop()
            self.counts[level] -= 1
        if level + size < self.window:
            self.counts[level + size] += 1
            self.open[level + size].append(which)
        return which, level


def pack_lengths(sizes: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """Window number and offset for each of the rests, in order of arrival."""
    levels = LevelArray(window)
    return [levels.place(n) for n in sizes]


def documents_tokens(path: str, end_id: int) -> Callable[[list[str]], list[bytes]]:
    """An encoder of texts with an end id, as little-endian 32-bit ids."""
    end = np.array([end_id], "<u4").tobytes()
    return lambda values: [ids + end for ids in encoder(path).encode(values)]


def pack(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = 2, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """One row per piece: the key, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    frame = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = frame.schema["key"].dataType
    encode = documents_tokens(path, end_id)
    measured = T.StructType([T.StructField("key", kind), T.StructField("tokens", T.LongType()), T.StructField("crcs", T.ArrayType(T.LongType()))])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            ids = encode(texts(batch.column("text")))
            schema = pa.schema([pa.field("key", batch.schema.field("key").type), pa.field("tokens", pa.int64()), pa.field("crcs", pa.list_(pa.int64()))])
            crcs = [[zlib.crc32(d[i : i + 4 * window]) for i in range(0, len(d), 4 * window)] for d in ids]
            yield table(schema, {"key": batch.column("key"), "tokens": [len(d) // 4 for d in ids], "crcs": crcs})

    shards = max(1, -(-df.count() // shard_docs))
    hashed = frame.mapInArrow(measure, measured).withColumn("hash", F.xxhash64("key", "tokens", "crcs"))
    dealt = hashed.withColumn("shard", F.pmod("hash", F.lit(shards)))
    out = T.StructType([T.StructField(key, kind), *T._parse_datatype_string(PIECES).fields])

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["hash", "tokens", "key"], kind="stable")
        rests = group["tokens"] % window
        placed = iter(pack_lengths([int(n) for n in rests if n], window))
        rows, extra = [], 0
        shard = int(group["shard"].iloc[0])
        full: list[tuple] = []
        made = 0
        for doc, tokens, crcs in zip(group["key"], group["tokens"], group["crcs"], strict=True):
            for i, crc in enumerate(crcs):
                start = i * window
                length = min(window, tokens - start)
                if length == window:
                    full.append((doc, start, length, int(crc), tokens, 0))
                else:
                    which, offset = next(placed)
                    made = max(made, which + 1)
                    rows.append((doc, start, length, int(crc), tokens, shard << 32 | which, offset))
        for extra, (doc, start, length, crc, tokens, offset) in enumerate(full):  # after the mixed windows
            rows.append((doc, start, length, crc, tokens, shard << 32 | (made + extra), offset))
        frame = pd.DataFrame(rows, columns=out.names)
        if isinstance(kind, T.IntegralType):
            frame[key] = frame[key].astype("Int64")
        return frame

    return dealt.groupBy("shard").applyInPandas(fill, out)
