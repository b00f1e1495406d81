"""Language identification by fusing the evidence on a page: text, markup, address, host.

log P(l | page) = t * log P(text | l) + log P(declared | l) + log P(address | l) + log P(l | host)

* *Text*: letter trigrams, hashed, with smoothed frequencies per language from a
  sample of labelled documents, drawn per language: all documents of a language that has
  up to `SAMPLE`, about `SAMPLE` of one that has more. Every language in the table counts. `t`
  tempers their sum, as trigrams aren't independent; it is chosen with frequencies from
  one half of the sample on the other half, then both halves are counted.
* *Declared*: the language that the markup names (html lang, xml:lang or
  content-language), and *address*: a language code in the path or in front of the
  host. How far to trust either comes from grouped counts over all pages of what is
  declared against what the text says, so a site generator's constant counts for little.
* *Host prior*: shares of languages by host, smoothed towards those of its
  domain, these towards those of the address suffix, these towards all pages. All are
  grouped sums over all rows; a row's own vote is taken out of its prior.

Rows of one host, even a third of all, are pre-aggregated in every task; the
priors are joined by host, which adaptive execution can split. Missing evidence (null text, or one without
trigrams, no markup, no address) adds nothing: such a text gives no vote to priors or trust, and text_lang is null. A table of documents without addresses uses its source as the host.
With no labelled documents the language is null. Ties go to the first language in order.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import pieces, raw, texts
from tidemark.session import durable

SAMPLE = 8192
SMOOTHING = 5.0
_SLOTS = 1 << 13
_TEMPERS = (1.0, 0.3, 0.1, 0.03, 0.01)

_LETTERS = np.array([c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)], np.uint8)
_HIDDEN = re.compile(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>", re.S | re.I)
_TAG = re.compile(r"<[^>]*>")
_DECLARED = re.compile(r"<html\b[^>]*?\b(?:xml:)?lang\s*=\s*[\"']?([A-Za-z]{2,3}(?:[-_][A-Za-z0-9]{1,8})*)\b|content-language[\"']?\s+content\s*=\s*[\"']?([A-Za-z]{2,3}(?:[-_][A-Za-z0-9]{1,8})*)\b", re.I)


def trigrams(data: bytes) -> np.ndarray:
    """Counts of hashed trigrams of letters, with at most one blank each."""
    x = _LETTERS[np.frombuffer(data, np.uint8)].astype(np.uint32)
    if len(x) < 3:
        return np.zeros(_SLOTS)
    blank = (x == 32).astype(np.int8)
    keep = blank[:-2] + blank[1:-1] + blank[2:] <= 1
    h = (x[:-2] << 16 | x[1:-1] << 8 | x[2:])[keep] * np.uint32(0x9E3779B1)
    return np.bincount(h >> np.uint32(32 - 13), minlength=_SLOTS).astype(np.float64)


def visible_text(page: str) -> str:
    return html.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", page)))


def code_of(tag: str, languages: frozenset[str]) -> str:
    """The longest start of a language tag that is a known language, else its first part."""
    parts = re.split("[-_]", tag.lower())
    for n in range(len(parts), 0, -1):
        for sign in "-_":
            if (code := sign.join(parts[:n])) in languages:
                return code
    return parts[0]


def address_parts(url: str | None, languages: frozenset[str] = frozenset()) -> tuple[str, str, str, str]:
    """Host, domain, suffix and language code of an address; empty where missing.

    A code is two letters, maybe with a region, or any known language.
    """
    try:
        parts = urlsplit(url or "")
        host = (parts.hostname or "").lower()
    except ValueError:
        return "", "", "", ""
    labels = [x for x in host.split(".") if x]
    steps = [*labels[:-2][:1], *parts.path.lower().split("/")[1:2]]
    code = next((code_of(s, languages) for s in steps if re.fullmatch(r"[a-z]{2}([-_][a-z]{2})?", s) or s in languages or code_of(s, languages) in languages), "")
    return host, ".".join(labels[-2:]), labels[-1] if labels else "", code


@dataclass
class TextModel:
    languages: list[str]
    log_shares: np.ndarray
    temper: float = 1.0

    def likelihoods(self, data: bytes) -> np.ndarray:
        """Tempered log likelihood of each language, the largest 0."""
        x = self.temper * (self.log_shares @ trigrams(data))
        return x - x.max() if len(x) else x


def fit_text(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> TextModel:
    docs = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"), F.lower(F.col(f"`{lang}`").cast("string")).alias("lang")).where("lang is not null and key is not null")
    sizes = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().collect()}
    names = sorted(sizes)
    if not names:
        return TextModel([], np.zeros((0, _SLOTS)))
    number = {name: i for i, name in enumerate(names)}
    shares = docs.sparkSession.createDataFrame([(name, min(1.0, sample / n)) for name, n in sizes.items()], "lang string, share double")
    drawn = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    half = F.pmod(F.xxhash64("key", F.lit(3)), F.lit(2)).cast("int").alias("half")
    rows = docs.join(F.broadcast(shares), "lang").where(drawn).select("lang", half, "text")  # one row a language is broadcast

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in pieces(batches, "text"):
            for name, at, data in zip(batch.column("lang").to_pylist(), batch.column("half").to_pylist(), raw(batch.column("text")), strict=True):
                place = at, number[name]
                total[place] = total[place] + trigrams(data) if place in total else trigrams(data)
        for (at, lang_at), n in total.items():
            slot = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(slot), at), pa.int32()), pa.array(np.full(len(slot), lang_at), pa.int32()), pa.array(slot, pa.int32()), pa.array(n[slot], pa.float64())], names=["half", "lang", "slot", "n"])

    found = rows.mapInArrow(count, "half int, lang int, slot int, n double").groupBy("half", "lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    halves = np.zeros((2, len(names), _SLOTS))
    halves[tuple(found.column(c).to_numpy() for c in ("half", "lang", "slot"))] = found.column("n").to_numpy()

    def fitted(n: np.ndarray) -> TextModel:
        return TextModel(names, np.log((n + 0.1) / (n + 0.1).sum(1, keepdims=True)))

    first = fitted(halves[0])

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(_TEMPERS))
        for batch in pieces(batches, "text"):
            for name, data in zip(batch.column("lang").to_pylist(), raw(batch.column("text")), strict=True):
                z = np.outer(_TEMPERS, first.likelihoods(data))
                total += np.log(np.exp(z).sum(1)) - z[:, number[name]]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(_TEMPERS)), pa.int32()), pa.array(total, pa.float64())], names=["temper", "loss"])

    model = fitted(halves.sum(0))
    tried = {r["temper"]: r["loss"] for r in rows.where("half = 1").select("lang", "text").mapInArrow(losses, "temper int, loss double").groupBy("temper").agg(F.sum("loss").alias("loss")).collect()}
    if any(tried.values()):
        model.temper = _TEMPERS[min(sorted(tried), key=tried.__getitem__)]
    return model


EVIDENCE = "id string, host string, domain string, suffix string, declared string, address string, x array<double>, best int"


def gather(rows: DataFrame, model: TextModel, markup: bool) -> DataFrame:
    """Evidence of each row of (id, body, url): what it says by itself. A text without trigrams is for no language."""
    languages = frozenset(model.languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "body"):
            out: list[list] = [[] for _ in range(8)]
            for name, body, url in zip(batch.column("id").to_pylist(), texts(batch.column("body")), batch.column("url").to_pylist(), strict=True):
                declared = ""
                if markup:
                    found = _DECLARED.search(body)
                    declared = code_of(found[1] or found[2], languages) if found else ""
                    body = visible_text(body)
                x = model.likelihoods(body.encode())
                places = address_parts(url, languages) if markup else (url or "", "", "", "")
                for column, value in zip(out, (name, *places[:3], declared, places[3], x.tolist(), int(x.argmax()) if len(x) and x.max() > x.min() else None), strict=True):
                    column.append(value)
            kinds = [pa.string()] * 6 + [pa.list_(pa.float64()), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["id", "host", "domain", "suffix", "declared", "address", "x", "best"])

    return rows.select(F.col("id").cast("string").alias("id"), F.col("body").cast("string").alias("body"), F.col("url").cast("string").alias("url")).mapInArrow(run, EVIDENCE)


def _trust(evidence: DataFrame, column: str, languages: list[str]) -> dict[str, np.ndarray]:
    """log P(value | language) for the known codes, any other code, and none (which says nothing)."""
    value = F.when(F.col(column).isin(languages), F.col(column)).otherwise("other")
    rows = evidence.where(F.col(column) != "").groupBy(value.alias("value"), "best").agg(F.count(F.lit(1)).alias("n")).collect()
    values = [*languages, "other"]
    n = np.zeros((len(values), len(languages)))
    for r in rows:
        if r["best"] is not None:
            n[values.index(r["value"]), r["best"]] += r["n"]
    start = np.full(n.shape, 0.5)
    np.fill_diagonal(start, 2.0)  # a code speaks for its language until counts say otherwise
    shares = (n + start) / (n + start).sum(0)
    return {v: np.log(s) for v, s in zip(values, shares, strict=True)} | {"": np.zeros(len(languages))}


def identify(rows: DataFrame, model: TextModel, markup: bool = True, smoothing: float = SMOOTHING) -> DataFrame:
    """id (as text), lang, probability, text_lang, declared for rows of (id, body, url)."""
    languages = model.languages
    evidence = durable(gather(rows, model, markup), "evidence")
    out = "id string, lang string, probability double, text_lang string, declared string"
    if not languages:
        none = F.lit(None).cast("string")
        return evidence.select("id", none.alias("lang"), F.lit(None).cast("double").alias("probability"), none.alias("text_lang"), "declared")
    declared, address = _trust(evidence, "declared", languages), _trust(evidence, "address", languages)
    votes = [F.count_if(F.col("best") == i).cast("double").alias(f"v{i}") for i in range(len(languages))]
    hosts = evidence.groupBy("host", "domain", "suffix").agg(*votes)
    sums = [F.sum(f"v{i}").alias(f"v{i}") for i in range(len(languages))]

    def together(frame: DataFrame, name: str, *keys: str) -> DataFrame:
        return frame.select(*keys, F.array(*[f"v{i}" for i in range(len(languages))]).alias(name))

    by_domain = hosts.groupBy("domain", "suffix").agg(*sums)
    by_suffix = by_domain.groupBy("suffix").agg(*sums)
    total = by_suffix.agg(*sums).first()
    everywhere = np.array([v or 0.0 for v in total])
    priors = together(hosts, "of_host", "host", "domain", "suffix") \
        .join(together(by_domain, "of_domain", "domain", "suffix"), ["domain", "suffix"]).join(together(by_suffix, "of_suffix", "suffix"), "suffix") \
        .select("host", "of_host", "of_domain", "of_suffix")

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = np.array(batch.column("x").to_pylist())
            best = batch.column("best").to_pylist()
            silent = len(languages)  # the place of rows whose text is for no language: they gave no vote
            own = np.eye(silent + 1)[[silent if i is None else i for i in best], :silent]
            share = everywhere[None, :] - own
            share = (share + 1) / (share + 1).sum(1, keepdims=True)
            for level in ("of_suffix", "of_domain", "of_host"):
                counts = np.maximum(np.array(batch.column(level).to_pylist()) - own, 0)
                share = (counts + smoothing * share) / (counts.sum(1, keepdims=True) + smoothing)
            z = x + np.log(share)
            for column, table in (("declared", declared), ("address", address)):
                z += np.array([table.get(v, table["other"]) for v in batch.column(column).to_pylist()])
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            at = p.argmax(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([languages[i] for i in at]), pa.array(p[np.arange(n), at]), pa.array([None if i is None else languages[i] for i in best], pa.string()), batch.column("declared")],
                names=["id", "lang", "probability", "text_lang", "declared"])

    return evidence.join(priors, "host").select("id", "declared", "address", "x", "best", "of_host", "of_domain", "of_suffix").mapInArrow(fuse, out)
