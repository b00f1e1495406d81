"""Removing benchmark passages: an FM-index per shard of documents, searched for every benchmark window.

Words are runs of letters, digits and signs beyond ASCII, in lower case. A
window is `window` consecutive words of an item, or all of a shorter one. Words
that no window has can't be part of an occurrence, so runs of them (and the ends
of documents) are one separator each in the index. A shard is a bounded run of
words from a task's rows: its index is built, each block of windows goes through
backward search, the rows found become positions by sampled suffixes, and the
words covered merge into spans. Longer documents are cut with an overlap that no
window exceeds, so no occurrence is lost.

Documents aren't shuffled. The windows of a block of items, at most about
`BLOCK_BYTES` of text, go along with the tasks; a larger benchmark takes several
passes, whose hits are joined by document.

Null or empty texts have no words, null or empty items no windows; an item
without a key has windows but isn't counted among the items. Repeated items all
count once by their key. Either table may be empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import pieces, raw
from tidemark.llm.fmindex import FMIndex

WINDOW = 10
SHARD_WORDS = 1 << 19
BLOCK_BYTES = 32 << 20

# Fixed value: every ASCII character but digits and letters ends a word; capital letters become small ones.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def split_words(data: bytes) -> list[bytes]:
    return data.translate(_TABLE).split()


@dataclass
class Windows:
    """The distinct windows of a block of items, by length, and the items that have each."""

    words: dict[bytes, int] = field(default_factory=dict)
    by_length: dict[int, np.ndarray] = field(default_factory=dict)
    owners: dict[int, list[list[str]]] = field(default_factory=dict)
    longest: int = 0

    @classmethod
    def of(cls, items: list[tuple[str | None, bytes]], window: int) -> Windows:
        out = cls()
        found: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for key, text in items:
            ids = [out.words.setdefault(w, len(out.words) + 1) for w in split_words(text)]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1 if ids else 0):
                owners = found.setdefault(size, {}).setdefault(tuple(ids[i : i + size]), set())
                if key is not None:
                    owners.add(key)
        for size, rows in found.items():
            out.by_length[size] = np.array(list(rows), np.int64)
            out.owners[size] = [sorted(o) for o in rows.values()]
            out.longest = max(out.longest, size)
        return out


class _Document:
    """Words covered and items found in one document, until all its parts are searched."""

    def __init__(self, words: int) -> None:
        self.words = words
        self.hits: list[np.ndarray] = []
        self.items: set[str] = set()

    def spans(self) -> list[tuple[int, int]]:
        """Merged runs [first, last) of covered words."""
        if not self.hits:
            return []
        edges = np.concatenate(self.hits)
        edges = edges[np.argsort(edges[:, 0], kind="stable")]
        ends = np.maximum.accumulate(edges[:, 1])
        new = np.concatenate([[True], edges[1:, 0] > ends[:-1]])
        starts = edges[new, 0]
        lasts = ends[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(ends) - 1]])]
        return list(zip(starts.tolist(), lasts.tolist(), strict=True))


class _Shard:
    def __init__(self, windows: Windows) -> None:
        self.windows = windows
        self.symbols: list[np.ndarray] = []
        self.origin: list[np.ndarray] = []  # the word's number in its document
        self.owner: list[np.ndarray] = []
        self.documents: list[_Document] = []
        self.size = 0

    def add(self, document: _Document, ids: np.ndarray, first: int) -> None:
        """Words of one document from number `first` on."""
        known = ids > 0
        keep = known.copy()
        keep[1:] |= known[:-1]  # the first of each run of other words stays as a separator
        at = np.flatnonzero(keep)
        number = len(self.documents)
        self.documents.append(document)
        self.symbols += [ids[at], np.zeros(1, np.int64)]
        self.origin += [at + first, np.zeros(1, np.int64)]
        self.owner += [np.full(len(at) + 1, number)]
        self.size += len(at) + 1

    def search(self) -> None:
        windows = self.windows
        if not self.documents or not windows.by_length:
            return
        index = FMIndex(np.concatenate(self.symbols))
        origin, owner = np.concatenate(self.origin), np.concatenate(self.owner)
        for size, patterns in windows.by_length.items():
            lo, hi = index.search(patterns)
            some = np.flatnonzero(hi > lo)
            if not len(some):
                continue
            counts = hi[some] - lo[some]
            which = np.repeat(some, counts)
            rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(lo[some], counts)
            at = index.locate(rows)
            by_doc = np.argsort(owner[at], kind="stable")
            at, which = at[by_doc], which[by_doc]
            docs, starts = np.unique(owner[at], return_index=True)
            for doc, a, b in zip(docs.tolist(), starts, [*starts[1:], len(at)], strict=True):
                document = self.documents[doc]
                first = origin[at[a:b]]
                document.hits.append(np.stack([first, first + size], 1))
                for w in np.unique(which[a:b]).tolist():
                    document.items.update(windows.owners[size][w])


def _searched(texts: Iterator[tuple[object, bytes]], windows: Windows, shard_words: int) -> Iterator[tuple[object, bytes, _Document]]:
    """Every document with its hits, in order; at most a shard's texts are held (or one longer text)."""
    overlap = max(0, windows.longest - 1)
    shard, ready, held = _Shard(windows), [], 0
    for key, text in texts:
        words = split_words(text)
        ids = np.fromiter(map(windows.words.get, words, [0] * len(words)), np.int64, len(words))
        document = _Document(len(words))
        first = 0
        while True:
            part = ids[first : first + shard_words]
            if shard.size and shard.size + len(part) > shard_words:
                shard.search()
                shard = _Shard(windows)
            if len(part):
                shard.add(document, part, first)
            if first + shard_words >= len(ids):
                break
            first += shard_words - overlap
        ready.append((key, text, document))
        held += len(text)
        if held > 8 * shard_words or shard.size > shard_words:
            shard.search()
            yield from ready
            shard, ready, held = _Shard(windows), [], 0
    shard.search()
    yield from ready


def without_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    if not spans:
        return text
    flags = np.frombuffer(text.translate(_TABLE), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : starts[a]])
        at = int(ends[b - 1])
    return b"".join([*out, text[at:]])


def _blocks(benchmark: DataFrame, key: str, text: str, block_bytes: int) -> Iterator[list[tuple[str | None, bytes]]]:
    frame = benchmark.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    total = frame.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    parts = max(1, -(-total // block_bytes))
    for i in range(parts):
        rows = frame.where(F.pmod(F.xxhash64("key", "text"), F.lit(parts)) == i).collect()  # one block, of bounded size
        yield [(r["key"], (r["text"] or "").encode()) for r in rows]


def find(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES, strip: bool = False) -> DataFrame:
    """Per document: key, n_words, spans of hit words, items found; with `strip` also the text that remains.

    With `strip` the benchmark must fit one block, or the text is stripped block
    after block by the caller; `decontaminate` does so.
    """
    frame = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    parts = [_pass(frame, Windows.of(block, window), shard_words, strip) for block in _blocks(benchmark, item, item_text, block_bytes)]
    if len(parts) == 1:
        return parts[0].withColumnRenamed("key", key)
    if strip:
        raise ValueError("strip takes one block")
    # rows of equal key and text have equal hits, so they may be merged and counted
    joined = parts[0].unionByName(parts[1])
    for part in parts[2:]:
        joined = joined.unionByName(part)
    merged = joined.groupBy("key", "digest", "n_words").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), (F.count(F.lit(1)) / len(parts)).cast("int").alias("times"))
    return merged.withColumn("copy", F.explode(F.sequence(F.lit(1), "times"))).drop("copy", "times").withColumnRenamed("key", key)


def _pass(frame: DataFrame, windows: Windows, shard_words: int, strip: bool) -> DataFrame:
    fields = [T.StructField("key", frame.schema["key"].dataType), *T._parse_datatype_string("digest binary, n_words long, spans array<struct<first:long,last:long>>, items array<string>").fields]
    schema = T.StructType([*fields, T.StructField("text", T.StringType())] if strip else fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = [pa.null()]

        def read() -> Iterator[tuple[object, bytes]]:
            for batch in batches:
                for piece in pieces(iter([batch]), "text"):
                    kind[0] = piece.schema.field("key").type
                    yield from zip(piece.column("key").to_pylist(), raw(piece.column("text")), strict=True)

        span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

        def pack(rows: list) -> pa.RecordBatch:
            spans = [d.spans() for _, _, d in rows]
            columns = [
                pa.array([k for k, _, _ in rows], kind[0]), pa.array([hashlib.md5(t).digest() for _, t, _ in rows], pa.binary()),
                pa.array([d.words for _, _, d in rows], pa.int64()), pa.array([[{"first": a, "last": b} for a, b in s] for s in spans], span),
                pa.array([sorted(d.items) for _, _, d in rows], pa.list_(pa.string())),
            ]
            if strip:
                columns.append(pa.array([without_words(t, s).decode() for (_, t, _), s in zip(rows, spans, strict=True)], pa.string()))
            return pa.RecordBatch.from_arrays(columns, names=schema.names)

        rows, size = [], 0
        for row in _searched(read(), windows, shard_words):
            rows.append(row)
            size += len(row[1])
            if size > 4 << 20:
                yield pack(rows)
                rows, size = [], 0
        if rows:
            yield pack(rows)

    return frame.mapInArrow(run, schema)


def report(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Numbers and a digest of each document's items."""
    covered = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["last"] - 1))))
    return found.select(
        key, "n_words", F.size(covered).cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All rows and columns, the text without the words of any occurrence."""
    others = [c for c in documents.columns if c != text]
    t = F.col(f"`{text}`").cast("string")
    rows = documents.select(F.struct(F.isnull(t).alias("none"), F.struct(F.lit(0).alias("one"), *[F.col(f"`{c}`") for c in others]).alias("row")).alias("key"), t.alias("text"))
    for block in _blocks(benchmark, "item_id", "text", block_bytes):
        rows = _pass(rows, Windows.of(block, window), SHARD_WORDS, True).select("key", "text")
    return rows.select(*[F.when(~F.col("key.none"), F.col("text")).alias(c) if c == text else F.col(f"key.row.`{c}`").alias(c) for c in documents.columns])
