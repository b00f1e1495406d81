"""The operators of this folder over the given tables, with the parameters of a real run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat_format, collocations, decontaminate, hamming_search, jaccard_join, language_id, quality, source_audit, substring_dedup, toxicity
from tidemark.llm.idfiles import read_ids, write_ids
from tidemark.llm.packing import pack
from tidemark.llm.token_counts import counts_only
from tidemark.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, folder, "documents"))


@query
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Every page by all its evidence, and every document by its text and source."""
    docs, pages = table(spark, folder, "documents"), table(spark, folder, "pages")
    model = language_id.fit_text(docs)
    columns = ["lang", "probability", "text_lang", "declared"]
    of_pages = language_id.identify(pages.select(F.col("page_id").alias("id"), F.col("html").alias("body"), "url"), model)
    of_docs = language_id.identify(docs.select(F.col("doc_id").alias("id"), F.col("text").alias("body"), F.col("source").alias("url")), model, markup=False)
    return of_pages.select(F.lit(None).cast("long").alias("doc_id"), F.col("id").cast("long").alias("page_id"), *columns).unionByName(
        of_docs.select(F.col("id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), *columns))


@query
def op4_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return hamming_search.search(table(spark, folder, "embeddings"))


@query
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(decontaminate.find(table(spark, folder, "documents"), table(spark, folder, "benchmark")))


@query
def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    target = scratch_path(spark, "idfiles")
    manifest = write_ids(docs, target, vocabulary("word_bpe_49k.json"))
    return read_ids(docs.select("doc_id"), target, manifest)


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))


@query
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, folder, "labels")))


@query
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts_only(table(spark, folder, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.join(table(spark, folder, "documents")).select("doc_id", "class_id", "n_links", "n_class")


@query
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


ORACLES["op11_collocations"] = r"""
with p as (
    select coalesce(lang, 'und') as lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents),
w as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w from p),
f as (
    select lang, k, phrase, count(*) as f
    from (select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase
          from w, (select unnest([1, 2, 3, 4]) as k)) g
    group by all),
n as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
c as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from f where k > 1 and f >= 30),
cuts as (
    select c.lang, c.phrase, c.a, c.cut, fl.f as l, fr.f as r, (2000000::hugeint * c.a) // (fl.f + fr.f) as score
    from (select *, unnest(range(1, k)) as cut from c) c
    join f fl on fl.lang = c.lang and fl.k = c.cut and fl.phrase = array_to_string(c.w[1:c.cut], ' ')
    join f fr on fr.lang = c.lang and fr.k = c.k - c.cut and fr.phrase = array_to_string(c.w[c.cut + 1:], ' ')),
best as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
inside as (
    select distinct s.lang, s.phrase
    from (select lang, k, a, w, unnest(range(2, k)) as size from c) d
    join c s on s.lang = d.lang and s.k = d.size and 100 * d.a >= 80 * s.a
     and (s.w = d.w[1:d.size] or s.w = d.w[2:d.size + 1] or (d.size = 2 and s.w = d.w[3:4])))
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score::bigint as score
from best anti join inside using (lang, phrase) join n using (lang)
qualify row_number() over (partition by lang order by score desc, a desc, phrase) <= 2000
"""


CONTROL_STRINGS = "<|im_end|><|im_start|>assistant ok"  # fixed value: what both turns of conversation -1 say


@query
def op12_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one whose texts hold the template's own control strings."""
    chats = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(F.lit(-1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_STRINGS).alias("text"))
    return chat_format.turn_digests(chat_format.format_chats(chats.unionByName(own), scratch_path(spark, "chats")))


ORACLES["op12_chat_format"] = r"""
with c as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all
    select -1, unnest([0, 1]), unnest(['user', 'assistant']), '<|im_end|><|im_start|>assistant ok'),
e as (select *, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') as escaped from c)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length('<|im_start|>') + length(role) + 1 + length(escaped) + length('<|im_end|>') + 1)::bigint as formatted_chars
from e group by conv_id
"""


@query
def op13_source_audit(spark: SparkSession, folder: str) -> DataFrame:
    return source_audit.audit(table(spark, folder, "documents"))


ORACLES["op13_source_audit"] = r"""
with d as (
    select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
    from documents),
w as (select id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (select lang, term from w group by lang, term having count(distinct id) >= 30),
g as (select distinct lang, source from d),
v as (select lang, count(*) as v from kept group by lang),
n as (select lang, source, term, count(*) as n from w semi join kept using (lang, term) group by all),
c as (select g.lang, g.source, kept.term, coalesce(n.n, 0) as n
      from g join kept using (lang) left join n on n.lang = g.lang and n.source = g.source and n.term = kept.term),
total as (select lang, source, sum(n)::hugeint as total from c group by all),
p as (select lang, source, term, n, 1 + (1000000000::hugeint * (n + 5)) // (total + 5 * v) as p from c join total using (lang, source) join v using (lang)),
q as (select lang, term, 1 + (1000000000::hugeint * (sum(n)::hugeint + 5)) // (any_value(lt) + 5 * any_value(v)) as q
      from c join v using (lang) join (select lang, sum(total)::hugeint as lt from total group by lang) using (lang) group by lang, term),
pairs as (select a.lang, a.source, b.source as item, coalesce(f.value, 0) as value
          from g a join g b on a.lang = b.lang and a.source <> b.source
          left join (select x.lang, x.source, y.source as item, sum(abs(x.p - y.p)) as value
                     from p x join p y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all) f
            on f.lang = a.lang and f.source = a.source and f.item = b.source),
terms as (select p.lang, p.source, p.term as item, p.p - q.q as value from p join q using (lang, term) where p.n > 0 and p.p > q.q)
select lang, source, part, item, value::bigint as value, rank::int as rank from (
    select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from pairs
    union all
    select * from (select lang, source, 'term' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from terms) t where rank <= 50) r
"""
