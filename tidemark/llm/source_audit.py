"""Source divergence audit: how the words of each source of a language differ from those of the others.

Terms are runs of letters and characters beyond ASCII, A-Z in lower case. Arrow
compute does the counting inside map tasks: `ascii_lower`, `split_pattern_regex`,
`dictionary_encode`, and hash groupings by (document, term), then by (group,
term), give partial counts of occurrences and documents. Spark merges them. A
language keeps the terms in at least `min_docs` of its documents, whatever
their source.

The merged counts are dealt into columnar shards: the terms of a language go by
hash to as many shards as keep sources x terms of one near `CELLS`, or, with many
sources, their terms near the number of sources and below `MOST_CELLS`. A shard is
one matrix, with a row per source of the language; it gives its part of each
pair's distance and its best terms of each group, which are added and ranked.
Hot sources and languages only get more shards. All arithmetic is in integers.

A null text, lang or source is the empty string; a text without terms still makes its group occur.
Repeated rows are documents of their own. A very long text is counted in parts. Equal values are
ranked by the item's bytes. A language without kept terms has its pairs with value 0; an empty
table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import pieces
from tidemark.session import durable

BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"  # fixed value: what separates terms
MIN_DOCS = 30
SMOOTH = 5
SCALE = 10**9
TOP_TERMS = 50
CELLS = 1 << 16
MOST_CELLS = 1 << 23
PIECE_BYTES = 16 << 20
_GAP = re.compile(BETWEEN.encode())


def _parts(text: pa.Array, limit: int) -> Iterator[pa.Array]:
    """The one text of an array, cut between terms into parts of about `limit` bytes."""
    data, at = text.cast(pa.binary())[0].as_py(), 0
    while at < len(data):
        gap = _GAP.search(data, at + limit)
        end = gap.start() if gap else len(data)
        yield pa.array([data[at:end]], pa.binary()).cast(pa.string())
        at = end


def _counted(text: pa.Array) -> pa.Table:
    """row, term, n: occurrences of each term in each text of the array."""
    import pyarrow.compute as pc

    split = pc.split_pattern_regex(pc.ascii_lower(text), pattern=BETWEEN)
    words = split.flatten().dictionary_encode()
    found = pa.table({"row": pc.list_parent_indices(split), "code": words.indices})
    grouped = found.group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")]).combine_chunks()
    terms = words.dictionary.take(grouped["code"].combine_chunks())
    out = pa.table({"row": grouped["row"], "term": terms, "n": grouped["count_all"]})
    return out.filter(pc.not_equal(out["term"], ""))


def partial_counts(batches: Iterator[pa.RecordBatch], limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Per piece of a task's texts: lang, source, term, occurrences n, documents; a row without term for each group."""
    import pyarrow.compute as pc

    for batch in pieces(batches, "text", limit):
        text = batch.column("text")
        if len(text) == 1 and pc.binary_length(text)[0].as_py() > limit:
            counted = pa.concat_tables([_counted(part) for part in _parts(text, limit)])
            counted = counted.group_by(["row", "term"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["row", "term", "n"])
        else:
            counted = _counted(text)
        groups = pa.table({"lang": batch.column("lang"), "source": batch.column("source"), "row": pa.array(range(len(text)), pa.int64())})
        kinds = groups.group_by(["lang", "source"], use_threads=False).aggregate([("row", "list")])
        of_row = np.empty(len(text), np.int64)
        of_row[kinds["row_list"].combine_chunks().flatten().to_numpy()] = pc.list_parent_indices(kinds["row_list"].combine_chunks()).to_numpy()
        # terms anew as codes, so that both groupings are by numbers
        coded = counted["term"].combine_chunks().dictionary_encode()
        merged = pa.table({"kind": of_row[counted["row"].to_numpy()], "code": coded.indices, "n": counted["n"]}).group_by(["kind", "code"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
        yield from pa.table({
            "lang": kinds["lang"].take(merged["kind"]), "source": kinds["source"].take(merged["kind"]),
            "term": coded.dictionary.take(merged["code"].combine_chunks()), "n": merged["n_sum"], "docs": merged["n_count"],
        }).to_batches(max_chunksize=1 << 16)
        none = pa.array([0] * len(kinds), pa.int64())
        yield from pa.table({"lang": kinds["lang"], "source": kinds["source"], "term": pa.nulls(len(kinds), pa.string()), "n": none, "docs": none}).to_batches()


def scaled_share(count: np.ndarray, total: np.ndarray | int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * terms)) by long division; exact for totals under 9e15."""
    below = np.asarray(total, np.int64) + SMOOTH * terms
    rest = np.asarray(count, np.int64) + SMOOTH
    out = np.zeros(np.broadcast_shapes(rest.shape, below.shape), np.int64)
    for _ in range(3):  # SCALE is three steps of a thousand; the first quotient is at most 1000
        whole, rest = np.divmod(rest * 1000, below)
        out = out * 1000 + whole
    return out + 1


def _shard(counts: pa.Table, groups: pa.Table) -> pa.Table:
    """A shard's part of every pair's distance and the best terms of every group."""
    names = sorted(zip(groups["source_"].to_pylist(), groups["total_"].to_pylist(), strict=True), key=lambda x: x[0].encode())
    lang, kept = groups["lang_"][0].as_py(), groups["kept_"][0].as_py()
    place = {name: i for i, (name, _) in enumerate(names)}
    terms = sorted(set(counts["term"].to_pylist()), key=str.encode)
    column = {t: j for j, t in enumerate(terms)}
    rows = {"source": [], "part": [], "item": [], "value": []}
    if terms:
        matrix = np.zeros((len(names), len(terms)), np.int64)
        matrix[[place[s] for s in counts["source"].to_pylist()], [column[t] for t in counts["term"].to_pylist()]] = counts["n"].to_numpy()
        totals = np.array([n for _, n in names], np.int64)
        share = scaled_share(matrix, totals[:, None], kept)
        of_lang = scaled_share(matrix.sum(0), int(totals.sum()), kept)
    for i, (name, _) in enumerate(names):
        apart = np.abs(share[i + 1 :] - share[i]).sum(1).tolist() if terms else [0] * (len(names) - i - 1)
        rows["source"] += [name] * len(apart)
        rows["part"] += ["pair"] * len(apart)
        rows["item"] += [other for other, _ in names[i + 1 :]]
        rows["value"] += apart
        if terms:
            more = share[i] - of_lang
            some = np.flatnonzero((matrix[i] > 0) & (more > 0))
            best = some[np.argsort(-more[some], kind="stable")[:TOP_TERMS]]
            rows["source"] += [name] * len(best)
            rows["part"] += ["term"] * len(best)
            rows["item"] += [terms[j] for j in best]
            rows["value"] += more[best].tolist()
    return pa.table({"lang": pa.array([lang] * len(rows["part"]), pa.string()), **{k: pa.array(v, pa.int64() if k == "value" else pa.string()) for k, v in rows.items()}})


def audit(documents: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, cells: int = CELLS) -> DataFrame:
    """lang, source, part, item, value, rank: every other source by distance, and the terms a source has more of."""
    plain = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    frame = documents.select(plain(text).alias("text"), plain(lang).alias("lang"), plain(source).alias("source"))
    counted = frame.mapInArrow(partial_counts, "lang string, source string, term string, n long, docs long")
    counts = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    same = Window.partitionBy("lang", "term")
    spread = counts.withColumns({"everywhere": F.sum("docs").over(same), "first": (F.min("source").over(same) == F.col("source")).cast("long")})
    kept = durable(spread.where(F.col("term").isNull() | (F.col("everywhere") >= min_docs)).drop("docs", "everywhere"), "audit")
    groups = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum(F.when(F.col("term").isNotNull(), F.col("first")).otherwise(0)).alias("terms"))
    langs = groups.groupBy("lang").agg(F.sum("terms").alias("kept"), F.count(F.lit(1)).alias("sources"))
    # Every shard gives a row for each pair of sources, so its terms should be as many as the sources where memory allows.
    wide = F.greatest(F.lit(1), F.floor(cells / F.col("sources")), F.least("sources", F.floor(MOST_CELLS / F.col("sources"))))
    langs = langs.select("lang", "kept", F.greatest(F.lit(1), F.ceil(F.col("kept") / wide)).cast("int").alias("shards"))
    left = kept.where("term is not null").join(langs, "lang").select("lang", F.pmod(F.xxhash64("term"), "shards").cast("int").alias("shard"), "source", "term", "n")
    right = groups.join(langs, "lang").select("lang", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "source", "total", "kept")
    right = right.select(*[F.col(c).alias(f"{c}_") for c in right.columns])  # names of its own, as both sides come from one table
    shards = left.groupBy("lang", "shard").cogroup(right.groupBy("lang_", "shard_")).applyInArrow(_shard, "lang string, source string, part string, item string, value long")
    found = durable(shards, "divergence")
    one_way = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = one_way.select("lang", F.explode(F.array(F.struct("source", "item", "value"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"), "value"))).alias("p"))
    pairs = pairs.select("lang", "p.source", F.lit("pair").alias("part"), "p.item", "p.value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = found.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP_TERMS)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms).select("lang", "source", "part", "item", "value", F.col("rank").cast(T.IntegerType()).alias("rank"))
