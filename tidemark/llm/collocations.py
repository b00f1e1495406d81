"""Collocations from a weighted de Bruijn graph of words.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and
pieces into words at spaces and tabs. In the graph of a language a node is three
words in a row and an edge four: it leads from its first three words to its last
three and weighs as often as they occur. A map task counts the edges of its
texts with numpy and Arrow, and the ends of pieces (the last three words, or all
of a shorter piece). Nothing shorter is counted; it follows from the flow:

* a node occurs as often as edges leave it, plus as often as it ends a piece;
* two words as often as nodes start with them, plus piece ends; one word likewise.

Edges and piece ends are shuffled once, with one row for each in a chunk of 8 MB,
by their first two words, and sorted; a task then sums the flow over nodes, pairs and
words in one pass over sorted rows, holding one open run of each. Pairs that a
bounded sample shows to be hot are dealt by three words: their parts, like those of single
words, are added by a grouped sum. The sample steers nothing but the dealing. Only
phrases of at least `least` occurrences go on, with all their parts, which occur
no less often. Among them, unary paths are compacted: where an edge is all that
enters a node and the next all that leaves it, both become one path with one
weight. In each round a path looks at the end with the lower hash; two that
choose the same node merge, so one shuffle does it and no row grows beyond
2**rounds edges. Nodes inside a path occur as often as its edges: they need no
look-up, neither as parts of an edge nor to see that a longer phrase covers them.

A phrase is scored at each cut by floor(2000000 a / (l + r)), its least score counts, and it is
dropped where a longer one of at least 80 % of its occurrences holds it. Products are decimals.

A null text is empty and has no words; a null lang is `und`. Repeated rows count each time. A very
long text is counted in parts, which overlap by three words where a piece is cut. Ties in the score go
to the more frequent, then the lesser phrase by bytes; an empty table gives no rows. Other columns
are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.llm.batches import pieces, raw
from tidemark.session import durable

LEAST = 30
TOP = 2000
COVERED = 80
ROUNDS = 5
CHUNK_BYTES = 8 << 20
SAMPLE_DOCS = 20_000
HOT = 512
SCORE = 2_000_000

# What ends a piece, and what parts words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(c + 32 if 65 <= c <= 90 else 10 if c in PIECE_ENDS else 32 if c == 9 else c for c in range(256))
_END = re.compile(rb"[.,;:!?\x0A-\x0D]")
_SPACE = re.compile(rb"[ \t]")


def _parts(data: bytes, limit: int) -> Iterator[tuple[bytes, bool]]:
    """Parts of about `limit` bytes and whether the last piece of each goes on in the next, which repeats up to three of its words."""
    at = 0
    while len(data) - at > 2 * limit:
        if end := _END.search(data, at + limit, at + 2 * limit):
            yield data[at : end.end()], False
            at = end.end()
            continue
        if (gap := _SPACE.search(data, at + limit)) is None:
            break
        part = data[at : gap.start()]
        open_piece = part[max(part.rfind(bytes([c])) for c in PIECE_ENDS) + 1 :]
        words = [m.start() for m in re.finditer(rb"[^ \t]+", open_piece)]
        if not words:
            yield part, False
            at = gap.start()
            continue
        following = gap.start() - (len(open_piece) - words[max(0, len(words) - 3)])
        if following <= at:  # three words fill the part: take it longer
            limit *= 2
            continue
        yield part, True
        at = following
    yield data[at:], False


def _grams(data: bytes, goes_on: bool, mark: bytes) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Distinct edges and piece ends of lower-cased pieces, as (`mark` and words, each followed by a space; counts)."""
    import pyarrow.compute as pc

    signs = np.frombuffer(data.translate(_TABLE), np.uint8)
    inside = np.zeros(len(signs) + 2, bool)
    inside[1:-1] = (signs != 32) & (signs != 10)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    held = signs[inside[1:-1]]
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(held)])
    coded = column.dictionary_encode()
    names, words = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    piece = np.cumsum(signs == 10, dtype=np.int32)[starts]
    size = len(names)
    two = pa.array(words[:-1] * size + words[1:]).dictionary_encode()
    couples, pair = two.dictionary.to_numpy(), two.indices.to_numpy().astype(np.int64)
    step = max(1, len(couples))
    nothing = pa.scalar(b"", pa.large_binary())
    heads = pc.binary_join_element_wise(pa.scalar(mark, pa.large_binary()), names, nothing)

    def phrases(first: np.ndarray, *others: np.ndarray) -> pa.Array:
        return pc.binary_join_element_wise(heads.take(pa.array(first)), *[names.take(pa.array(c)) for c in others], nothing, pa.scalar(b" ", pa.large_binary()))

    def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = pc.value_counts(pa.array(keys))
        return found.field("values").to_numpy(), found.field("counts").to_numpy()

    whole = np.flatnonzero(piece[:-3] == piece[3:]) if len(words) > 3 else np.zeros(0, np.int64)
    if len(whole):
        keys, n = counted(pair[whole] * step + pair[whole + 2])
        first, second = couples[keys // step], couples[keys % step]
        yield phrases(first // size, first % size, second // size, second % size), n
    last = np.flatnonzero(np.concatenate([piece[1:] != piece[:-1], [not goes_on]]))
    count = np.minimum(3, np.diff(last, prepend=-1))
    if len(last):  # a piece's end counts once in each length
        keys, n = counted(words[last])
        yield phrases(keys), n
    if len(at := last[count >= 2]):
        keys, n = counted(pair[at - 1])
        yield phrases(couples[keys] // size, couples[keys] % size), n
    if len(at := last[count == 3]):
        keys, n = counted(pair[at - 2] * size + words[at])
        first = couples[keys // size]
        yield phrases(first // size, first % size, keys % size), n


def _mark(lang: str) -> bytes:
    """What stands before the words of a language; it holds no space and ends with the only tab."""
    return lang.replace("%", "%25").replace("\t", "%09").replace(" ", "%20").encode() + b"\t"


def partial_edges(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Per chunk of a task's texts: language and words in one string, occurrences; edges and ends of pieces."""
    held: dict[str, list[bytes]] = {}
    size = 0

    def counts(lang: str, data: bytes, goes_on: bool) -> Iterator[pa.RecordBatch]:
        for phrase, n in _grams(data, goes_on, _mark(lang)):
            columns = [phrase.cast(pa.large_string()).cast(pa.string()), pa.array(n, pa.int64())]
            yield from pa.table(columns, names=["gram", "f"]).to_batches(max_chunksize=1 << 16)

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, texts in held.items():
            yield from counts(lang, b"\n".join(texts), False)
        held.clear()

    for batch in pieces(batches, "text", limit):
        for lang, text in zip(batch.column("lang").to_pylist(), raw(batch.column("text")), strict=True):
            if len(text) > 2 * limit:
                for part, goes_on in _parts(text, limit):
                    yield from counts(lang, part, goes_on)
                continue
            held.setdefault(lang, []).append(text)
            size += len(text) + 1
            if size > limit:
                yield from flush()
                size = 0
    yield from flush()


class _Runs:
    """Sums over runs of equal first `k` words in sorted rows, across batches."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.open: tuple[bytes, int] | None = None

    def add(self, grams: pa.Array, f: np.ndarray) -> Iterator[tuple[bytes, int] | tuple[pa.Array, np.ndarray]]:
        """The runs that ended, the one carried from the batch before first."""
        import pyarrow.compute as pc

        starts = np.concatenate([[0], np.flatnonzero(pc.not_equal(grams[1:], grams[:-1]).to_numpy(zero_copy_only=False)) + 1])
        sums = np.add.reduceat(f, starts)
        first = grams[0].as_py()
        if self.open is not None:
            if self.open[0] == first:
                sums[0] += self.open[1]
            else:
                yield pa.array([self.open[0]], pa.binary()), np.array([self.open[1]])
        self.open = (grams[int(starts[-1])].as_py(), int(sums[-1]))
        if len(starts) > 1:
            yield grams.take(pa.array(starts[:-1])), sums[:-1]

    def close(self) -> Iterator[tuple[pa.Array, np.ndarray]]:
        if self.open is not None:
            yield pa.array([self.open[0]], pa.binary()), np.array([self.open[1]])


def _prefixes(grams: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, pa.Array]]]:
    """For k = 1 to 4, the rows of at least k words and their first k words."""
    n = len(grams)
    _, offsets, values = grams.buffers()
    at = np.frombuffer(offsets, np.int32)[grams.offset : grams.offset + n + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    spaces = np.flatnonzero(data == 32)
    first = np.searchsorted(spaces, at)
    count = np.diff(first)
    out = []
    for k in range(1, 5):
        rows = np.flatnonzero(count >= k)
        ends = spaces[first[:-1][rows] + k - 1] + 1
        inside = np.zeros(len(data) + 1, np.int8)
        inside[at[:-1][rows]] += 1
        inside[ends] -= 1  # each end is another place
        kept = data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
        lengths = np.concatenate([[0], np.cumsum(ends - at[:-1][rows])]).astype(np.int32)
        out.append((rows, pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(lengths), pa.py_buffer(kept)])))
    return out


def flows(batches: Iterator[pa.RecordBatch], least: int, hot: set[bytes]) -> Iterator[pa.RecordBatch]:
    """Sums of sorted edges and piece ends: of all one-word prefixes and hot pairs (a part each), and of the frequent longer ones."""
    levels = {k: _Runs(k) for k in range(1, 5)}

    def out(k: int, grams: pa.Array, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        keep = sums >= least if k > 1 else np.ones(len(sums), bool)
        if k == 2 and hot:
            keep |= pc.is_in(grams, pa.array(sorted(hot), pa.binary())).to_numpy(zero_copy_only=False)
        if keep.any():
            grams = grams.filter(pa.array(keep)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([grams, pa.array([k] * len(grams), pa.int32()), pa.array(sums[keep], pa.int64())], names=["gram", "words", "f"])

    for batch in batches:
        if not batch.num_rows:
            continue
        f = batch.column("f").to_numpy()
        for (k, runs), (rows, grams) in zip(levels.items(), _prefixes(batch.column("gram")), strict=True):
            if len(rows):
                for found in runs.add(grams, f[rows]):
                    yield from out(k, *found)
    for k, runs in levels.items():
        for found in runs.close():
            yield from out(k, *found)


def _first(k: int, phrase: str = "phrase") -> Column:
    return F.substring_index(phrase, " ", k)


def _last(k: int, phrase: str = "phrase") -> Column:
    return F.substring_index(phrase, " ", -k)


def _hot_pairs(frame: DataFrame, docs: int = SAMPLE_DOCS) -> list[str]:
    """Pairs of words that begin more than 1 / HOT of the edges of a sample; at most HOT of them. They only steer the shuffle."""
    rows = frame.count()
    sample = frame if rows <= docs else frame.sample(docs / rows, seed=11)
    pairs = sample.mapInArrow(partial_edges, "gram string, f long").groupBy(_first(2, "gram").alias("pair")).count()
    total = Observation()
    largest = pairs.observe(total, F.sum("count").alias("rows")).orderBy(F.desc("count"), "pair").limit(HOT).collect()
    return [r["pair"] + " " for r in largest if r["count"] * HOT > total.get["rows"]]


def frequent(documents: DataFrame, least: int = LEAST, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, words, phrase, f: all phrases of one to four words that occur often enough, and per language the count of all words (words = 0)."""
    frame = documents.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"))
    hot = _hot_pairs(frame)
    found = frame.mapInArrow(partial_edges, "gram string, f long")
    pair = F.concat(_first(2, "gram"), F.lit(" "))
    place = F.when(pair.isin(hot), _first(3, "gram")).otherwise(_first(2, "gram")) if hot else _first(2, "gram")
    wanted = {p.encode() for p in hot}
    dealt = found.repartition(F.xxhash64(place)).sortWithinPartitions("gram")
    summed = dealt.mapInArrow(lambda batches: flows(batches, least, wanted), "gram string, words int, f long").groupBy("gram", "words").agg(F.sum("f").alias("f"))
    plain = lambda c: F.replace(F.replace(F.replace(c, F.lit("%20"), F.lit(" ")), F.lit("%09"), F.lit("\t")), F.lit("%25"), F.lit("%"))
    rows = summed.select(plain(F.substring_index("gram", "\t", 1)).alias("lang"), "words", F.rtrim(F.substring_index("gram", "\t", -1)).alias("phrase"), "f")
    rows = durable(rows.where((F.col("words") == 1) | (F.col("f") >= least)), "flows")
    totals = rows.where("words = 1").groupBy("lang").agg(F.sum("f").alias("f")).select("lang", F.lit(0).alias("words"), F.lit("").alias("phrase"), "f")
    return rows.where(F.col("f") >= least).unionByName(totals)


def compact(paths: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Paths (lang, path, f, f_head, f_tail) joined at unary nodes, in some rounds; f_head and f_tail count the end nodes."""
    columns = ["lang", "path", "f", "f_head", "f_tail"]
    for k in range(rounds):
        weigh = lambda end: F.xxhash64("lang", end, F.lit(k))
        entered = F.when(F.col("f") == F.col("f_head"), weigh(_first(3, "path")))
        left = F.when(F.col("f") == F.col("f_tail"), weigh(_last(3, "path")))
        marked = paths.withColumns({"entered": entered, "left": left})
        after = F.col("left").isNotNull() & (F.col("entered").isNull() | (F.col("left") <= F.col("entered")))
        marked = marked.withColumns({"after": after, "node": F.when(after, _last(3, "path")).when(F.col("entered").isNotNull(), _first(3, "path"))})
        whole = F.struct(*columns[1:])
        met = marked.where("node is not null").groupBy("lang", "node").agg(F.max(F.when(F.col("after"), whole)).alias("a"), F.max(F.when(~F.col("after"), whole)).alias("b"))
        rest = F.expr("substring(b.path, length(substring_index(b.path, ' ', 3)) + 1)")
        joined = F.struct(F.concat("a.path", rest).alias("path"), "a.f", "a.f_head", "b.f_tail")
        both = F.col("a").isNotNull() & F.col("b").isNotNull()
        now = met.select("lang", F.when(both, joined).otherwise(F.coalesce("a", "b")).alias("p")).select("lang", "p.*")
        paths = durable(now.unionByName(marked.where("node is null").select(*columns)), "paths")
    return paths


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP, text: str = "text", lang: str = "lang", rounds: int = ROUNDS) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score."""
    often = durable(frequent(documents, least, text, lang), "phrases")
    level = lambda k: often.where(F.col("words") == k)
    nodes = level(3).select("lang", F.col("phrase").alias("node"), F.col("f").alias("f_node"))
    ends = level(4).select("lang", F.col("phrase").alias("path"), "f")
    for end, of in (("f_head", _first(3, "path")), ("f_tail", _last(3, "path"))):
        ends = ends.withColumn("node", of).join(nodes, ["lang", "node"]).withColumnRenamed("f_node", end).drop("node")
    paths = compact(durable(ends, "edges"), rounds)

    cut = paths.select("lang", F.split("path", " ").alias("w"), "f", "f_head", "f_tail").withColumn("n_edges", F.size("w") - 3)
    runs = cut.select("lang", "w", "f", "f_head", "f_tail", "n_edges", F.posexplode(F.sequence(F.lit(0), F.col("n_edges") - 1)).alias("i", "_"))
    joined = lambda n: F.array_join(F.slice("w", F.col("i") + 1, n), " ")
    four = runs.select(
        "lang", joined(4).alias("phrase"), F.col("f").alias("a"),
        F.when(F.col("i") == 0, F.col("f_head")).otherwise(F.col("f")).alias("l3"),
        F.when(F.col("i") == F.col("n_edges") - 1, F.col("f_tail")).otherwise(F.col("f")).alias("r1"))
    # what covers a node: a path it ends, or the path it is inside
    around = runs.select("lang", joined(3).alias("node"), "f").union(paths.select("lang", _last(3, "path").alias("node"), "f"))
    covers = around.groupBy("lang", "node").agg(F.max("f").alias("longer"))
    three = _uncovered(level(3).select("lang", "phrase", F.col("f").alias("a")), covers)
    around = level(3).select("lang", F.explode(F.array(_first(2), _last(2))).alias("node"), "f")
    two = _uncovered(level(2).select("lang", "phrase", F.col("f").alias("a")), around.groupBy("lang", "node").agg(F.max("f").alias("longer")))

    none = F.lit(None).cast("long")
    parts = {  # slot: the part's place; those of an edge's nodes are known
        4: {"l1": _first(1), "l2": _first(2), "r2": _last(2), "r3": _last(1)},
        3: {"l1": _first(1), "r1": _last(2), "l2": _first(2), "r2": _last(1)},
        2: {"l1": _first(1), "r1": _last(1)},
    }
    asked = None
    for k, rows in ((4, four), (3, three.withColumns({"l3": none, "r1": none})), (2, two.withColumns({"l3": none, "r1": none}))):
        slots = F.explode(F.array(*[F.struct(F.lit(slot).alias("slot"), part.alias("part")) for slot, part in parts[k].items()])).alias("s")
        rows = rows.select("lang", "phrase", "a", "l3", "r1", slots).select("lang", "phrase", "a", "l3", "r1", "s.*")
        asked = rows if asked is None else asked.union(rows)
    known = often.where("words in (1, 2)").select("lang", F.col("phrase").alias("part"), F.col("f").alias("f_part"))
    got = lambda slot: F.max(F.when(F.col("slot") == slot, F.col("f_part")))
    filled = asked.join(known, ["lang", "part"]).groupBy("lang", "phrase").agg(
        F.max("a").alias("a"), got("l1").alias("l1"), F.coalesce(F.max("r1"), got("r1")).alias("r1"),
        got("l2").alias("l2"), got("r2").alias("r2"), F.max("l3").alias("l3"), got("r3").alias("r3"))
    at_cut = [F.when(F.col(f"l{k}").isNotNull(), F.struct(F.expr(f"cast(a as decimal(20, 0)) * {SCORE} div (cast(l{k} as decimal(20, 0)) + r{k})").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in (1, 2, 3)]
    scored = filled.select("lang", "phrase", "a", F.array_min(F.filter(F.array(*at_cut), lambda x: x.isNotNull())).alias("c")).select("lang", "phrase", "a", "c.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(level(0).select("lang", F.col("f").alias("n")), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _uncovered(rows: DataFrame, covers: DataFrame) -> DataFrame:
    """Phrases that no longer one holds nearly as often."""
    found = rows.join(covers.withColumnRenamed("node", "phrase"), ["lang", "phrase"], "left")
    wide = lambda c, k: F.col(c).cast("decimal(20,0)") * k
    return found.where(F.col("longer").isNull() | (wide("longer", 100) < wide("a", COVERED))).select("lang", "phrase", "a")
