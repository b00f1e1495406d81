"""Token counts: batch encoding inside Arrow tasks that return lengths only.

Texts go to the library in batches of about equal bytes. A long text is split
where no token can reach across: before a single space between two characters
that are neither spaces nor the sign a space is written as. A file whose pieces
would cross such a place is used without splitting, so counts are always those
of the library. Nothing is shuffled; a task holds one batch.

Null and empty texts have 0 tokens; rows and all other columns stay as they are
(columns named like the new ones are replaced).
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import pieces, table, texts

BATCH_BYTES = 1 << 20
PART_CHARS = 1 << 15
_SPACE = "▁"
_SAFE = re.compile(rf"(?<=[^\s{_SPACE}]) (?=[^\s{_SPACE}])")
_counters: dict[str, Counter] = {}


class Counter:
    """Lengths of encoded texts, for either kind of file."""

    def __init__(self, path: str) -> None:
        if path.endswith(".model"):
            import sentencepiece

            self.model = sentencepiece.SentencePieceProcessor(model_file=path)
            names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
            inside = any(_SPACE in name.lstrip(_SPACE) for name in names)
            # "b" alone must be what " b" is inside a text, and spaces must stay as they are
            self.splits = not inside and all(
                self.model.encode(a + " " + b) == self.model.encode(a) + self.model.encode(b)
                and self.model.encode(a + "  " + b) != self.model.encode(a + " " + b)
                for a, b in (("The", "end"), ("x", "1"), (".", "."))
            )
            self._lengths = lambda batch: [len(x) for x in self.model.encode(batch, num_threads=1)]
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.splits = False
            self._lengths = lambda batch: [len(x) for x in tokenizer.encode_batch_fast(batch, add_special_tokens=False)]

    def parts(self, text: str, size: int = PART_CHARS) -> list[str]:
        if not self.splits or len(text) <= size:
            return [text]
        out, start = [], 0
        while len(text) - start > size and (cut := _SAFE.search(text, start + size)):
            out.append(text[start : cut.start()])
            start = cut.end()
        return [*out, text[start:]]

    def count(self, batch: list[str], limit: int = BATCH_BYTES) -> list[int]:
        totals = [0] * len(batch)
        held: list[str] = []
        owners: list[int] = []
        size = 0

        def flush() -> None:
            for owner, n in zip(owners, self._lengths(held) if held else [], strict=True):
                totals[owner] += n
            held.clear()
            owners.clear()

        for i, text in enumerate(batch):
            for part in self.parts(text):
                held.append(part)
                owners.append(i)
                size += len(part) if part.isascii() else len(part.encode())
                if size >= limit:
                    flush()
                    size = 0
        flush()
        return totals


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(df: DataFrame, path: str, text: str = "text", limit: int = 4096) -> DataFrame:
    """Add n_bytes, n_tokens and over_limit (more than `limit` tokens) to every row."""
    added = {"n_bytes": T.LongType(), "n_tokens": T.LongType(), "over_limit": T.BooleanType()}
    kept = [f for f in df.schema.fields if f.name not in added or f.name == text]
    if text in added:
        raise ValueError(f"the text column must not be named {text}")
    carried = [f for f in kept if f.name != text]
    frame = df.select(F.struct(*[F.col(f"`{f.name}`") for f in carried]).alias("row") if carried else F.lit(0).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([frame.schema["row"], T.StructField("text", T.StringType()), *[T.StructField(k, v) for k, v in added.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in pieces(batches, "text"):
            values = texts(batch.column("text"))
            n = count.count(values)
            widths = [len(v.encode()) for v in values]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("text"), pa.array(widths, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=["row", "text", *added],
            )

    out = frame.mapInArrow(run, schema)
    columns = [F.col("text").alias(text) if f.name == text else F.col(f"row.`{f.name}`").alias(f.name) for f in kept]
    return out.select(*columns, *added)


def counts_only(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 4096) -> DataFrame:
    """The same lengths without the texts: nothing but numbers leaves the task."""
    frame = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([T.StructField("key", frame.schema["key"].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in pieces(batches, "text"):
            values = texts(batch.column("text"))
            n = count.count(values)
            yield table(
                pa.schema([pa.field("key", batch.schema.field("key").type), pa.field("n_bytes", pa.int64()), pa.field("n_tokens", pa.int64()), pa.field("over_limit", pa.bool_())]),
                {"key": batch.column("key"), "n_bytes": [len(v.encode()) for v in values], "n_tokens": n, "over_limit": [x > limit for x in n]},
            )

    return frame.mapInArrow(run, schema).withColumnRenamed("key", key)
