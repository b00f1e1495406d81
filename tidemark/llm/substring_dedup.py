"""Removing every long byte string that occurs more than once, across all documents.

A window is a string of `length` bytes. All equal windows must meet in one
shard, whose Burrows-Wheeler transform then tells which windows repeat
(`bwt.repeated_starts`), yet shards must stay small:

1. *Anchors.* In each window the gram of half its length with the least hash is
   its anchor, so equal windows have equal anchors. About one byte in a hundred
   starts one. Grams that occur once are dropped. One shuffle by the gram counts grams and neighbourhoods.
2. *Neighbourhoods.* An anchor's windows lie within `length` / 2 bytes around it.
   Equal neighbourhoods of one anchor are counted and stand for each other with two
   occurrences, so that a passage copied a million times is examined as two.
3. *Hot anchors.* An anchor with more than `cap` different neighbourhoods is cut in
   two: windows that start in the left half of the range share a longer gram, and
   so do those of the right half. Halves that are still hot are cut again, at last to
   single windows, which have one neighbourhood each. Nothing is dropped. Halves are cut from the
   different neighbourhoods' bytes, not from the documents, and their repeats go back to the neighbourhoods.
4. *Shards.* Tasks read the neighbourhoods in the order of the first document that
   has them, so that neighbouring anchors come together and their overlapping bytes join to one text,
   in shards of about `SHARD_BYTES`, all of an anchor in one shard. A shard's bytes are those of the joined texts, in
   whatever order the pieces of a document come, so with an anchor's largest group it stays below `suffixes.MAX_SYMBOLS`.
5. Marks go back to every occurrence and merge to spans per document.

Hashes only decide what meets; whether windows are equal is decided by the transform
(or by equal 128-bit marks of anchor and neighbourhood, for occurrences that one other stands for).

Null text is empty. Documents shorter than a window are kept whole. Rows
repeated in full count as copies of each other. Matches never cross documents.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import pieces, raw, table
from tidemark.llm.bwt import repeated_starts
from tidemark.session import durable

LENGTH = 400
#: Neighbourhoods of one anchor that are examined together at most: about 3 MB with two occurrences each.
CAP = 2500
SHARD_BYTES = 950_000
#: Pieces of a shard, which overlap; text with an anchor at every byte would else hold far more than its bytes.
SHARD_ROWS = 65_536
#: Bytes of a document whose anchors come together; times `CAP`, the most that one task can't share.
_STRETCH = 4096
_SEGMENT = 1 << 18
_PRIME = 0x9E3779B97F4A7C15
_RANDOM = np.random.default_rng(20240229)
_BYTES = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []

OCCURRENCE = "key long, near long, r1 long, r2 int, lo long"
_PLACE = "struct<r1:long,r2:int,lo:long>"
_CUT = "key long, near long, width int, n long, shard long, at long, single boolean, r1 long, r2 int, lo long, first long, piece binary"
_STARTS = "starts array<struct<first:long,last:long>>"


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        inverse = pow(_PRIME, -1, 1 << 64)
        _powers[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, p, np.uint64)])) for p in (_PRIME, inverse)]
    return _powers[0], _powers[1]


class Hashes:
    """Hashes of any substrings of some bytes that depend on nothing but their content."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = _power(len(data))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[: len(data)])])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (self.sums[end] - self.sums[start]) * self.down[start]
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, 1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def _segments(data: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """Runs of window starts [a, b) with the bytes [c, d) that their anchors' neighbourhoods need."""
    last = len(data) - length + 1
    for a in range(0, last, _SEGMENT):
        b = min(last, a + _SEGMENT)
        yield a, b, max(0, a - length), min(len(data), b + 2 * length)


def find_anchors(data: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Keys, neighbourhoods' hashes and first window starts (relative to the text, before clipping), and the starts' range."""
    gram = max(1, length // 2)
    width = length - gram
    last = -1
    for a, b, c, d in _segments(data, length):
        part = data[c:d]
        hashes = Hashes(part)
        at = np.arange(a - c, b - c + width)
        grams = hashes.of(at, at + gram)
        # the leading bits decide, then the later of equals
        low = np.uint64((1 << 22) - 1)
        packed = (grams & ~low) | (low - np.arange(len(at)).astype(np.uint64) & low)
        least = window_minimum(packed, width + 1)
        chosen = least[np.concatenate([[True], least[1:] != least[:-1]])]
        where = np.unique((low - (chosen & low)).astype(np.int64))
        where = where[where + a > last]  # windows on both sides of a cut mostly have the same anchor
        if not len(where):
            continue
        last = int(where[-1]) + a
        anchor = where + (a - c)
        yield grams[where].view(np.int64), _near(hashes, anchor - width, width, length, len(data), c), anchor - width + c, width


def _near(hashes: Hashes, lo: np.ndarray, width: int, length: int, size: int, shift: int) -> np.ndarray:
    """Hash of the bytes that the windows starting in [lo, lo + width] cover, and of how they are clipped."""
    first = np.maximum(lo, -shift)
    last = np.minimum(lo + width + length, size - shift)
    clipped = (first - lo).astype(np.uint64) * np.uint64(_PRIME)
    return (hashes.of(first, last) ^ clipped).view(np.int64)


def _occurrences(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64()), ("near", pa.int64()), ("r1", pa.int64()), ("r2", pa.int32()), ("lo", pa.int64())])
        for batch in pieces(batches, "text"):
            found: list[list[np.ndarray]] = [[] for _ in schema]
            for r1, r2, text in zip(batch.column("r1").to_pylist(), batch.column("r2").to_pylist(), raw(batch.column("text")), strict=True):
                if len(text) < length:
                    continue
                for key, near, lo, _ in find_anchors(np.frombuffer(text, np.uint8), length):
                    for column, values in zip(found, (key, near, np.full(len(key), r1), np.full(len(key), r2), lo), strict=True):
                        column.append(values)
            if found[0]:
                yield table(schema, {name: np.concatenate(c) for name, c in zip(schema.names, found, strict=True)})

    return docs.mapInArrow(run, OCCURRENCE)


def halved(los: np.ndarray, widths: np.ndarray, last: int, first: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the ranges that hold starts in [first, last], each once."""
    mid = widths // 2
    lo, width = np.concatenate([los, los + mid + 1]), np.concatenate([mid, widths - mid - 1])
    valid = (np.maximum(lo, first) <= np.minimum(lo + width, last)) & (width >= 0)
    lo, width = np.unique(np.stack([lo[valid], width[valid]]), axis=1)
    return lo, width


def halves_of(piece: bytes, first: int, width: int, length: int) -> list[tuple[int, int, int, int, int, bytes]]:
    """The two longer grams that a neighbourhood is cut into: shift, width, key, near, and the bytes with the first one's place.

    `first` is where the piece begins in the neighbourhood, later than 0 where a text begins.
    """
    end = first + len(piece)
    lo, widths = halved(np.zeros(1, np.int64), np.array([width], np.int64), end - length, first)
    hashes = Hashes(np.frombuffer(piece, np.uint8))
    start, stop = np.maximum(lo, first), np.minimum(lo + widths + length, end)
    key = hashes.of(lo + widths - first, lo + length - first).view(np.int64)
    near = (hashes.of(start - first, stop - first) ^ ((start - lo).astype(np.uint64) * np.uint64(_PRIME))).view(np.int64)
    rows = zip(lo.tolist(), widths.tolist(), key.tolist(), near.tolist(), start.tolist(), stop.tolist(), strict=True)
    return [(a, w, k, x, b - a, piece[b - first : e - first]) for a, w, k, x, b, e in rows]


def _halves(hot: DataFrame, length: int) -> DataFrame:
    """For each hot neighbourhood its halves, with the neighbourhood they come from and their shift in it."""
    schema = T._parse_datatype_string("of_key long, of_near long, of_width int, shift long, key long, near long, width int, first long, piece binary, n long, "
                                      f"one {_PLACE}, two {_PLACE}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "piece"):
            rows = []
            for r in batch.to_pylist():
                for shift, width, key, near, first, piece in halves_of(r["piece"], r["first"], r["width"], length):
                    one, two = ({**r[c], "lo": r[c]["lo"] + shift} for c in ("one", "two"))
                    rows.append({"of_key": r["key"], "of_near": r["near"], "of_width": r["width"], "shift": shift, "key": key, "near": near, "width": width, "first": first, "piece": piece, "n": r["n"], "one": one, "two": two})
            place = pa.struct([("r1", pa.int64()), ("r2", pa.int32()), ("lo", pa.int64())])
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), place, place]
            for i in range(0, len(rows), 4096):
                yield pa.RecordBatch.from_pylist(rows[i : i + 4096], pa.schema(list(zip(schema.names, kinds, strict=True))))

    return hot.select("key", "near", "width", "first", "piece", "n", "one", "two").mapInArrow(run, schema)


def _repeated(occurrences: DataFrame) -> DataFrame:
    """The occurrences of keys that occur again. Of each neighbourhood: n, the number (`nth`) in it, `single` if all are at one place; of each key: kinds, head."""
    key, near = Window.partitionBy("key"), Window.partitionBy("key", "near")
    places = near.orderBy("r1", "r2", "lo")
    again = occurrences.withColumn("times", F.count(F.lit(1)).over(key)).where("times > 1").drop("times")
    numbered = again.withColumn("nth", F.row_number().over(places)).withColumn("place", F.rank().over(places))
    counted = numbered.withColumn("n", F.count(F.lit(1)).over(near)).withColumn("single", F.max("place").over(near) == 1).drop("place")
    return counted.withColumn("kinds", F.sum((F.col("nth") == 1).cast("long")).over(key)).withColumn("head", F.min(F.struct("r1", "lo")).over(key))


def find_repeats(docs: DataFrame, length: int = LENGTH, cap: int = CAP) -> DataFrame:
    """Window starts that repeat: r1, r2 (the row's marks), ranges [first, last] of its starts."""
    width = length - max(1, length // 2)
    repeated = durable(_repeated(_occurrences(docs, length)), "repeated")
    hot = (F.col("kinds") > cap) & F.lit(width > 0)
    shard = F.xxhash64("head.r1", F.floor(F.col("head.lo") / _STRETCH))
    slots = repeated.where((F.col("kinds") > 1) | (F.col("n") > 1)).where((F.col("nth") == 1) | ((F.col("nth") == F.col("n")) & ~F.col("single") & ~hot)) \
        .select("r1", "r2", F.struct("key", "near", F.lit(width).alias("width"), "n", F.when(hot, F.xxhash64("near")).otherwise(shard).alias("shard"), F.when(~hot, F.col("head.lo")).alias("at"), "single", "lo").alias("slot"))
    examined = durable(_examined(_pieces(docs, slots, length), length), "examined")
    # the levels' repeats, and how their neighbourhoods lie in those of the level before
    found = [examined.where("piece is null").select("key", "near", "width", "starts")]
    links = []
    place = F.struct("r1", "r2", "lo")
    near = repeated.where(hot).groupBy("key", "near").agg(F.max("n").alias("n"), F.min(place).alias("one"), F.max(place).alias("two"))
    parts = examined.where("piece is not null").select("key", "near", "width", "first", "piece").dropDuplicates(["key", "near"]).join(near, ["key", "near"])
    while not parts.isEmpty():
        halves = durable(_halves(parts, length), "halves")
        links.append(halves.select("of_key", "of_near", "of_width", "shift", "key", "near", "width"))
        # halves of different neighbourhoods may be one: what lies at one place is counted once
        near = halves.groupBy("key", "near", "width").agg(F.max("n").alias("n"), F.min("one").alias("one"), F.max("two").alias("two"), F.first("first").alias("first"), F.first("piece").alias("piece"))
        of_key = Window.partitionBy("key")
        near = durable(near.withColumn("kinds", F.count(F.lit(1)).over(of_key)).withColumn("head", F.min(F.struct("one.r1", "one.lo")).over(of_key)), "near")
        hot = (F.col("kinds") > cap) & (F.col("width") > 0)
        single = F.col("one") == F.col("two")
        cool = near.where(~hot & ((F.col("kinds") > 1) | (F.col("n") > 1) | ~single)).select(
            "key", "near", "width", "n", shard.alias("shard"), F.col("head.lo").alias("at"), single.alias("single"), "first", "piece",
            F.explode(F.when(single, F.array("one")).otherwise(F.array("one", "two"))).alias("place"))
        cuts = cool.select("key", "near", "width", "n", "shard", "at", "single", "place.r1", "place.r2", "place.lo", (F.col("first") + F.col("place.lo")).alias("first"), "piece")
        found.append(_examined(cuts, length).select("key", "near", "width", "starts"))
        parts = near.where(hot)
    every = found.pop()
    while links:
        link, up = links.pop(), found.pop()
        moved = F.transform("starts", lambda s: F.struct((s["first"] + F.col("shift")).alias("first"), (s["last"] + F.col("shift")).alias("last")))
        below = link.join(every, ["key", "near", "width"]).select(F.col("of_key").alias("key"), F.col("of_near").alias("near"), F.col("of_width").alias("width"), moved.alias("starts"))
        every = up.unionByName(below)
    starts = F.explode(F.transform("starts", lambda s: F.struct((s["first"] + F.col("lo")).alias("first"), (s["last"] + F.col("lo")).alias("last"))))
    return repeated.select("key", "near", "r1", "r2", "lo").join(every.select("key", "near", "starts"), ["key", "near"]).select("r1", "r2", starts.alias("s")) \
        .groupBy("r1", "r2").agg(F.collect_set("s").alias("starts"))


def _pieces(docs: DataFrame, slots: DataFrame, length: int) -> DataFrame:
    """The bytes of each neighbourhood at its places; the documents move once."""
    by_doc = slots.groupBy("r1", "r2").agg(F.collect_list("slot").alias("slots"))

    def slice_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            rows = []
            for r1, r2, text, slots in zip(batch.column("r1").to_pylist(), batch.column("r2").to_pylist(), raw(batch.column("text")), batch.column("slots").to_pylist(), strict=True):
                for s in slots:
                    first = max(0, s["lo"])
                    end = min(len(text), s["lo"] + s["width"] + length)
                    rows.append((s["key"], s["near"], s["width"], s["n"], s["shard"], s["at"], s["single"], r1, r2, s["lo"], first, text[first:end]))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            names = [f.split()[0] for f in _CUT.split(", ")]
            for i in range(0, len(rows), 8192):
                columns = zip(*rows[i : i + 8192], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return docs.join(by_doc, ["r1", "r2"]).select("r1", "r2", "text", "slots").mapInArrow(slice_texts, _CUT)


def _examined(cuts: DataFrame, length: int) -> DataFrame:
    """For each neighbourhood the starts of its windows that repeat, relative to its range; one without `at` is hot and passes with its piece."""
    starts = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    schema = pa.schema([("key", pa.int64()), ("near", pa.int64()), ("width", pa.int32()), ("first", pa.int64()), ("piece", pa.binary()), ("starts", starts)])

    def examine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in shards(_rows(batches), SHARD_BYTES, SHARD_ROWS):
            hot = [{**r, "first": r["first"] - r["lo"]} for r in held if r["at"] is None]
            if hot:
                yield pa.RecordBatch.from_pylist(hot, schema)
            if len(hot) < len(held):
                out = _marks([r for r in held if r["at"] is not None], length)
                yield pa.RecordBatch.from_arrays([*out.columns[:3], pa.nulls(out.num_rows, pa.int64()), pa.nulls(out.num_rows, pa.binary()), out.column(3)], schema=schema)

    return cuts.repartition("shard").sortWithinPartitions("shard", "at", "key").mapInArrow(
        examine, f"key long, near long, width int, first long, piece binary, {_STARTS}")


def shards(rows: Iterable[dict], most_bytes: int, most_rows: int) -> Iterator[list[dict]]:
    """Runs of rows whose joined texts have about `most_bytes`, all rows of a key in one."""
    held: list[dict] = []
    stretches: dict[tuple[int, int], list[tuple[int, int]]] = {}
    size = 0
    for row in rows:
        if held and (size >= most_bytes or len(held) >= most_rows) and held[-1]["key"] != row["key"]:
            yield held
            held, stretches, size = [], {}, 0
        held.append(row)
        size += added(stretches.setdefault((row["r1"], row["r2"]), []), row["first"], row["first"] + len(row["piece"]))
    if held:
        yield held


def added(stretches: list[tuple[int, int]], first: int, end: int) -> int:
    """Put [first, end) to a document's stretches, in order and apart from each other; the number of bytes that are new."""
    a = bisect_left(stretches, first, key=itemgetter(1))
    b = bisect_right(stretches, end, key=itemgetter(0))
    old = stretches[a:b]
    whole = (min(first, old[0][0]), max(end, old[-1][1])) if old else (first, end)
    stretches[a:b] = [whole]
    return whole[1] - whole[0] - sum(y - x for x, y in old)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            yield from batch.slice(i, 512).to_pylist()


def _marks(rows: list[dict], length: int) -> pa.RecordBatch:
    """Join the pieces of each document where they overlap, and look the shard's repeats up for each row."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i]["r1"], rows[i]["r2"], rows[i]["first"]))
    texts: list[bytearray] = []
    where: dict[int, tuple[int, int]] = {}
    last, begin = None, 0
    for i in order:
        r = rows[i]
        at = (r["r1"], r["r2"])
        if at == last and r["first"] <= begin + len(texts[-1]):
            texts[-1] += r["piece"][begin + len(texts[-1]) - r["first"] :]
        else:
            texts.append(bytearray(r["piece"]))
            last, begin = at, r["first"]
        where[i] = (len(texts) - 1, r["first"] - begin)
    starts = repeated_starts([bytes(t) for t in texts], length)
    out: dict[str, list] = {"key": [], "near": [], "width": [], "starts": []}
    seen = set()
    for i, r in enumerate(rows):
        mark = (r["key"], r["near"], r["width"])
        if mark in seen:
            continue
        seen.add(mark)
        windows = len(r["piece"]) - length + 1
        shift = r["first"] - r["lo"]
        if r["single"] and r["n"] > 1:  # rows repeated in full: one place that occurs more than once
            ranges = [{"first": shift, "last": shift + windows - 1}]
        else:
            which, offset = where[i]
            a, b = np.searchsorted(starts[which], [offset, offset + windows])
            found = starts[which][a:b] - offset
            if not len(found):
                continue
            cuts = np.flatnonzero(np.diff(found) != 1)
            ranges = [{"first": int(x) + shift, "last": int(y) + shift} for x, y in zip(found[np.concatenate([[0], cuts + 1])], found[np.concatenate([cuts, [len(found) - 1]])], strict=True)]
        for name, value in zip(out, (*mark, ranges), strict=True):
            out[name].append(value)
    return table(pa.schema([("key", pa.int64()), ("near", pa.int64()), ("width", pa.int32()), ("starts", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))]), out)


def covered_runs(starts: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the windows that start in the ranges."""
    runs: list[list[int]] = []
    for s in sorted(starts or [], key=lambda s: s["first"]):
        if runs and s["first"] <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], s["last"] + length)
        else:
            runs.append([s["first"], s["last"] + length])
    return [(a, b) for a, b in runs]


def marked(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and text with two marks of the row, by which its findings come back to it."""
    k, t = F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")
    return documents.select(k.alias("key"), t.alias("text"), F.xxhash64(k, t).alias("r1"), F.hash(t, k).alias("r2"))


def remove_repeats(documents: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, cap: int = CAP) -> DataFrame:
    """Per row: the key, n_bytes, n_removed, n_spans, kept_sha256."""
    docs = marked(documents, key, text)
    found = docs.join(find_repeats(docs, length, cap), ["r1", "r2"], "left").select("key", "text", "starts")
    schema = T.StructType([T.StructField("key", docs.schema["key"].dataType), *T._parse_datatype_string("n_bytes long, n_removed long, n_spans long, kept_sha256 string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
            for data, starts in zip(raw(batch.column("text")), batch.column("starts").to_pylist(), strict=True):
                runs = covered_runs(starts, length)
                out["n_bytes"].append(len(data))
                out["n_removed"].append(sum(b - a for a, b in runs))
                out["n_spans"].append(len(runs))
                out["kept_sha256"].append(hashlib.sha256(without(data, runs)).hexdigest())
            yield table(pa.schema([batch.schema.field("key"), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]), {"key": batch.column("key"), **out})

    return found.mapInArrow(run, schema).withColumnRenamed("key", key)


def without(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in runs:
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]])


def remove_repeats_from_texts(documents: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, cap: int = CAP) -> DataFrame:
    """All rows and columns, the text without its repeated strings; characters cut in part go whole."""
    others = [c for c in documents.columns if c != text]
    whole = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col(f"`{text}`").cast("string").alias("text"),
        F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")).alias("r1"), F.hash(F.col(f"`{text}`").cast("string"), F.col(f"`{key}`")).alias("r2"))
    found = whole.join(find_repeats(marked(documents, key, text), length, cap), ["r1", "r2"], "left").select("row", "text", "starts")
    schema = T.StructType([found.schema["row"], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            kept = [without(d, covered_runs(s, length)).decode(errors="ignore") if s else t for d, t, s in zip(raw(batch.column("text")), batch.column("text").to_pylist(), batch.column("starts").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(kept, pa.string())], names=["row", "text"])

    out = found.mapInArrow(run, schema)
    return out.select(*[F.col("text").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in documents.columns])
