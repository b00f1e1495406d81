"""Scalar functions and feature transforms."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import records as R
from tidemark.functions import scalar as S
from tidemark.functions import transforms as T
from tidemark.model import FeatureGroup
from tidemark.operators.select import sql_transform as _sql_transform
from tidemark.plans.fixtures import frame
from tidemark.plans.registry import query

AS_OF = "2024-02-01"
FREQ = """
    select {c} as label, row_number() over (order by count(*) desc, {c}) - 1 as label_index
    from {t} group by {c}"""
EVENT_LABELS = FREQ.format(c="event_type", t="events")


@query("select p_partkey, lower(p_type) as category, lower(p_brand) as brand from part")
def fn_lower(spark: SparkSession, d: str) -> DataFrame:
    return frame(spark, d, "part").select(
        "p_partkey", F.lower("p_type").alias("category"), F.lower("p_brand").alias("brand")
    )


@query("""
    select event_id, replace(replace(replace(replace(concat(event_type, '$?&#', props), '$', '_D_'), '?', '_Q_'),
               '&', '_A_'), '#', '_H_') as escaped,
           concat(event_type, '$?&#', props) as restored
    from events""")
def fn_tag_escape(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat("event_type", F.lit("$?&#"), "props")
    return frame(spark, d, "events").select(
        "event_id", S.tag_escape(text).alias("escaped"), S.tag_unescape(S.tag_escape(text)).alias("restored")
    )


@query("select c_custkey, md5(c_name) as name_md5 from customer")
def fn_md5(spark: SparkSession, d: str) -> DataFrame:
    return frame(spark, d, "customer").select("c_custkey", S.md5_hex(F.col("c_name")).alias("name_md5"))


@query("select event_id, strftime(date_trunc('milliseconds', ts), '%Y-%m-%dT%H:%M:%S.%gZ') as iso from events")
def fn_iso8601(spark: SparkSession, d: str) -> DataFrame:
    return frame(spark, d, "events").select("event_id", S.iso8601(F.col("ts")).alias("iso"))


@query("""
    select l_orderkey, l_linenumber, l_partkey,
           strftime(to_timestamp(l_orderkey * 1000 + l_partkey) at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ') as iso
    from lineitem""")
def fn_epoch_iso(spark: SparkSession, d: str) -> DataFrame:
    seconds = F.col("l_orderkey") * 1000 + F.col("l_partkey")
    return frame(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", S.epoch_to_iso(seconds).alias("iso")
    )


@query("select event_id, case when event_type = 'error' then null else date_trunc('second', ts) end as parsed from events")
def fn_parse_ts(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    return frame(spark, d, "events").select("event_id", S.parse_ts(text).alias("parsed"))


@query(f"select o_orderkey, date_diff('day', cast(o_orderdate as date), date '{AS_OF}') as days from orders")
def fn_days_since(spark: SparkSession, d: str) -> DataFrame:
    days = S.days_since(F.col("o_orderdate"), AS_OF).cast("long")
    return frame(spark, d, "orders").select("o_orderkey", days.alias("days"))


@query("select customer_id, cast(age as bigint) as age, c_mktsegment from {customers}")
def typed_record(spark: SparkSession, d: str) -> DataFrame:
    rows = frame(spark, d, "customers").select("customer_id", "age", "c_mktsegment")
    fg = FeatureGroup.from_frame("customers", rows, "customer_id", "customer_id")
    return R.from_records(R.to_records(rows, fg), fg)


@query("select customer_id, cast(age as bigint) as age, c_mktsegment from {customers}")
def records_typed(spark: SparkSession, d: str) -> DataFrame:
    rows = frame(spark, d, "customers").select("customer_id", "age", "c_mktsegment")
    fg = FeatureGroup.from_frame("customers", rows, "customer_id", "customer_id")
    return R.long_to_rows(R.records_long(R.to_records(rows, fg)), fg)


@query("""
    select p_partkey, coalesce((select string_agg(cast((p_partkey * 31 + i * 17) % 31 as varchar), ',' order by i)
               from range(1, cast(floor(10.0 * p_size / 50.0) as bigint) + 1) r(i)), '') as days
    from part""")
def array_feature(spark: SparkSession, d: str) -> DataFrame:
    days = S.day_list(F.col("p_size") / 50.0, F.col("p_partkey"))
    return frame(spark, d, "part").select("p_partkey", F.concat_ws(",", days).alias("days"))


@query(f"""
    select event_id, label_index as event_type
    from events join ({EVENT_LABELS}) l on event_type = label""")
def ordinal_freq(spark: SparkSession, d: str) -> DataFrame:
    return T.ordinal_encode(frame(spark, d, "events").select("event_id", "event_type"), "event_type", "freq")


@query("""
    select event_id, dense_rank() over (order by event_type) - 1 as event_type from events""")
def ordinal_alpha(spark: SparkSession, d: str) -> DataFrame:
    return T.ordinal_encode(frame(spark, d, "events").select("event_id", "event_type"), "event_type", "alpha")


@query("""
    select p_partkey, round((p_retailprice - lo) / (hi - lo), 2) as p_retailprice
    from part, (select min(p_retailprice) as lo, max(p_retailprice) as hi from part) b""")
def minmax_scale(spark: SparkSession, d: str) -> DataFrame:
    return T.minmax(frame(spark, d, "part").select("p_partkey", "p_retailprice"), "p_retailprice")


@query("""
    select o_orderkey, round((o_totalprice - m) / s, 6) as o_totalprice
    from orders, (select avg(o_totalprice) as m, stddev_pop(o_totalprice) as s from orders) b""")
def standard_scale(spark: SparkSession, d: str) -> DataFrame:
    scaled = T.standard_scale(frame(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice")
    return scaled.withColumn("o_totalprice", F.round("o_totalprice", 6))


AGE_CASE = """case when age >= 18 and age <= 30 then '18-29' when age > 30 and age <= 40 then '30-39'
           when age > 40 and age <= 50 then '40-49' when age > 50 and age <= 60 then '50-59'
           when age > 60 and age <= 70 then '60-69' when age > 70 and age <= 90 then '70-plus' end"""


@query(f"select customer_id, age, {AGE_CASE} as age_range from {{customers}}")
def bucketize_right(spark: SparkSession, d: str) -> DataFrame:
    return T.bucketize(frame(spark, d, "customers").select("customer_id", "age"), "age", output="age_range")


@query("""
    select p_partkey, cast(p_type = 'ECONOMY' as int) as type_ECONOMY, cast(p_type = 'LARGE' as int) as type_LARGE,
           cast(p_type = 'MEDIUM' as int) as type_MEDIUM, cast(p_type = 'PROMO' as int) as type_PROMO,
           cast(p_type = 'SMALL' as int) as type_SMALL, cast(p_type = 'STANDARD' as int) as type_STANDARD
    from part""")
def one_hot(spark: SparkSession, d: str) -> DataFrame:
    return T.one_hot(frame(spark, d, "part").select("p_partkey", "p_type"), "p_type", "type")


@query("select order_id, cast(is_reordered as int) as is_reordered from {order_facts}")
def bool_to_int(spark: SparkSession, d: str) -> DataFrame:
    return T.bool_to_int(frame(spark, d, "order_facts").select("order_id", "is_reordered"), "is_reordered")


@query(f"""
    select o_orderkey, round(cast(n - lo as double) / (hi - lo), 2) as n_days from (
        select o_orderkey, date_diff('day', cast(o_orderdate as date), date '{AS_OF}') as n,
               min(date_diff('day', cast(o_orderdate as date), date '{AS_OF}')) over () as lo,
               max(date_diff('day', cast(o_orderdate as date), date '{AS_OF}')) over () as hi
        from orders) t""")
def days_since_scaled(spark: SparkSession, d: str) -> DataFrame:
    return T.days_since_scaled(
        frame(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "n_days", AS_OF
    )


@query("""
    select o_orderkey, if(o_totalprice > 250000, 'high', 'low') as band, o_totalprice * 0.01e0 as cents
    from orders where o_orderstatus <> 'P'""")
def sql_transform(spark: SparkSession, d: str) -> DataFrame:
    return _sql_transform(
        frame(spark, d, "orders"),
        "raw-orders",
        lambda name: f"""
            select o_orderkey, if(o_totalprice > 250000, 'high', 'low') as band, o_totalprice * 0.01D as cents
            from {name} where o_orderstatus <> 'P'""",
    )


@query("select l_orderkey, l_linenumber, l_partkey, l_quantity * l_extendedprice as amount from lineitem")
def pandas_transform(spark: SparkSession, d: str) -> DataFrame:
    def amounts(batch: pd.DataFrame) -> pd.DataFrame:
        out = batch[["l_orderkey", "l_linenumber", "l_partkey"]].copy()
        out["amount"] = batch["l_quantity"] * batch["l_extendedprice"]
        return out

    rows = frame(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"
    )
    return T.pandas_transform(rows, amounts, "l_orderkey long, l_linenumber int, l_partkey long, amount double")


@query("""
    select event_id, user_id, ts, value, cast(event_type = 'purchase' as bigint) as is_purchase from events""")
def flow_cast(spark: SparkSession, d: str) -> DataFrame:
    events = frame(spark, d, "events")
    text = events.select(
        F.col("event_id").cast("string"), F.col("user_id").cast("string"), F.col("ts").cast("string"),
        F.col("value").cast("string"), (F.col("event_type") == "purchase").cast("int").cast("string").alias("is_purchase"),
    )
    return T.run_flow(text, [T.infer_and_cast, lambda df: T.cast_columns(df, {"is_purchase": "bigint"})])


@query("""
    select l_orderkey, l_partkey, l_linenumber, l_quantity, l_shipdate, l_returnflag from lineitem""")
def infer_and_cast(spark: SparkSession, d: str) -> DataFrame:
    lines = frame(spark, d, "lineitem")
    names = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate", "l_returnflag"]
    text = lines.select(*[F.col(c).cast("string").alias(c) for c in names])
    return T.infer_and_cast(text)


@query(f"""
    with f as (select is_reordered as label, row_number() over (order by count(*) desc, cast(is_reordered as varchar)) - 1
                  as label_index from {{order_facts}} group by is_reordered),
         t as (select order_id, customer_id, purchase_amount, is_reordered,
                  date_diff('day', cast(purchased_on as date), date '{AS_OF}') as n from {{order_facts}}),
         b as (select min(purchase_amount) as alo, max(purchase_amount) as ahi, min(n) as nlo, max(n) as nhi from t)
    select order_id, customer_id, cast(label_index as int) as is_reordered,
           round((purchase_amount - alo) / (ahi - alo), 2) as purchase_amount,
           round(cast(n - nlo as double) / (nhi - nlo), 2) as n_days_since_last_purchase
    from t join f on t.is_reordered = f.label, b""")
def prepare_orders(spark: SparkSession, d: str) -> DataFrame:
    rows = frame(spark, d, "order_facts")
    rows = rows.select("order_id", "customer_id", "purchase_amount", "is_reordered", "purchased_on")
    return T.prepare_orders(rows, AS_OF)


@query(f"""
    with t as (select *, {AGE_CASE} as r, date_diff('day', active_since, date '{AS_OF}') as n from {{customers}}),
         b as (select min(n) as lo, max(n) as hi from t)
    select customer_id, cast(sex as bigint) as sex, cast(is_married as bigint) as is_married,
           coalesce(cast(r = '18-29' as int), 0) as "age_18-29", coalesce(cast(r = '30-39' as int), 0) as "age_30-39",
           coalesce(cast(r = '40-49' as int), 0) as "age_40-49", coalesce(cast(r = '50-59' as int), 0) as "age_50-59",
           coalesce(cast(r = '60-69' as int), 0) as "age_60-69",
           coalesce(cast(r = '70-plus' as int), 0) as "age_70-plus",
           cast(n - lo as double) / (hi - lo) as n_days_active
    from t, b""")
def prepare_customers(spark: SparkSession, d: str) -> DataFrame:
    rows = frame(spark, d, "customers").select("customer_id", "age", "sex", "is_married", "active_since", "c_mktsegment")
    return T.prepare_customers(rows, AS_OF, drop=["c_mktsegment"])


@query("""
    select product_id, event_time, cast(product_category = 'economy' as int) as category_economy,
           cast(product_category = 'large' as int) as category_large,
           cast(product_category = 'medium' as int) as category_medium,
           cast(product_category = 'promo' as int) as category_promo,
           cast(product_category = 'small' as int) as category_small,
           cast(product_category = 'standard' as int) as category_standard
    from {products}""")
def prepare_products(spark: SparkSession, d: str) -> DataFrame:
    rows = frame(spark, d, "products").select("product_id", "event_time", "product_name", "product_category")
    return T.prepare_products(rows)


@query("""
    select o_orderkey, (select count(distinct o_custkey) from orders) as size, dense_rank() over (order by cast(o_custkey as varchar)) - 1 as place
    from orders""")
def one_hot_many(spark: SparkSession, d: str) -> DataFrame:
    """A category for every customer, as sparse vectors."""
    rows = frame(spark, d, "orders").select("o_orderkey", "o_custkey")
    return T.one_hot_sparse(rows, "o_custkey", "vector").select("o_orderkey", "vector.size", "vector.place")


@query("""
    with c as (select l_returnflag, cast(l_partkey as varchar) as p, l_linenumber, l_orderkey from lineitem),
    f as (select l_returnflag as label, row_number() over (order by count(*) desc, l_returnflag) - 1 as place from c where l_returnflag is not null group by l_returnflag),
    p as (select p as label, row_number() over (order by count(*) desc, p) - 1 as place from c where p is not null group by p),
    n as (select l_linenumber as label, row_number() over (order by count(*) desc, cast(l_linenumber as varchar)) - 1 as place from c where l_linenumber is not null group by l_linenumber)
    select l_orderkey, f.place as l_returnflag, p.place as l_partkey, n.place as l_linenumber, (select count(*) from p) as parts, p.place as part_at
    from c left join f on l_returnflag = f.label left join p on c.p = p.label left join n on l_linenumber = n.label""")
def encode_many(spark: SparkSession, d: str) -> DataFrame:
    """Three columns by one dictionary: as indices, and one of them as a sparse vector too."""
    lines = frame(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_partkey", "l_linenumber", F.col("l_partkey").alias("vector"))
    names = ["l_returnflag", "l_partkey", "l_linenumber"]
    coded = T.encode_many(T.encode_many(lines, names, "freq"), ["vector"], "freq", vectors=True)
    # as text a sparse vector is (size,[places],[values])
    parts = F.split(F.regexp_replace(F.col("vector").cast("string"), r"[()\[\]]", ""), ",")
    return coded.select("l_orderkey", *names, parts[0].cast("long").alias("parts"), parts[1].cast("long").alias("part_at"))
