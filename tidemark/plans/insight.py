"""Profiles, drift, training and scoring, lineage and the feature catalog."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import definitions_frame
from tidemark.operators import catalog as C
from tidemark.operators import learn as N
from tidemark.operators import lineage as O
from tidemark.operators import monitor as M
from tidemark.operators.dataset import latest_featureset as _featureset
from tidemark.operators.dataset import star_join as _star_join
from tidemark.operators.latest import latest, materialized
from tidemark.plans.fixtures import frame, group, with_group
from tidemark.plans.registry import query
from tidemark.session import durable, scratch_path
from tidemark.sources import reports as R

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _each(columns: list[str], select: str) -> str:
    return "\n    union all\n    ".join(select.format(c=c) for c in columns)


def _rounded(df: DataFrame, *columns: str, places: int = 3) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


@query(_each(LINE_NUMBERS, """
    select '{c}' as name, count({c}) as value_count, count(*) - count({c}) as missing_count, min({c}) as minimum,
           max({c}) as maximum, round(avg({c}), 3) as mean, round(stddev_samp({c}), 3) as standard_deviation
    from lineitem"""))
def profile_numeric(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(M.profile_numeric(frame(spark, d, "lineitem"), LINE_NUMBERS), "mean", "standard_deviation")


ENTROPY = """
    select '{c}' as name, count(*) as distinct_count, round(ln(sum(n)) - sum(n * ln(n)) / sum(n), 6) as entropy
    from (select {c}, count(*) as n from {t} where {c} is not null group by {c}) t"""


@query(_each(["l_returnflag", "l_quantity", "l_partkey"], ENTROPY.replace("{t}", "lineitem")))
def profile_entropy(spark: SparkSession, d: str) -> DataFrame:
    found = M.profile_entropy(frame(spark, d, "lineitem"), ["l_returnflag", "l_quantity", "l_partkey"])
    return _rounded(found, "entropy", places=6)


@query("""
    select * from (
        select name, value, n, cast(row_number() over (partition by name order by n desc, value) as int) as position
        from (select 'event_type' as name, event_type as value, count(*) as n from events group by event_type
              union all
              select 'user_id', cast(user_id as varchar), count(*) from events group by user_id) c) t
    where position <= 5""")
def profile_topk(spark: SparkSession, d: str) -> DataFrame:
    return M.profile_topk(frame(spark, d, "events"), ["event_type", "user_id"], 5)


@query(_each(["l_quantity", "l_extendedprice"], """
    select '{c}' as name, least(cast(floor(({c} - lo) / ((hi - lo) / 10)) as bigint), 9) as bin, count(*) as n
    from lineitem, (select min({c}) as lo, max({c}) as hi from lineitem) b group by 1, 2"""))
def profile_histogram(spark: SparkSession, d: str) -> DataFrame:
    return M.profile_histogram(frame(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"], 10)


@query("""
    select 'value' as name,
           greatest(least(cast(floor((value - m) / s) as bigint), 4), -4) as deviations, count(*) as n
    from events, (select avg(value) as m, stddev_pop(value) as s from events) b group by 1, 2""")
def profile_zscore(spark: SparkSession, d: str) -> DataFrame:
    return M.profile_zscore(frame(spark, d, "events"), ["value"])


@query("""
    select 'l_quantity' as name, 'l_extendedprice' as other, round(corr(l_quantity, l_extendedprice), 6) as correlation
    from lineitem
    union all select 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 6) from lineitem
    union all select 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, l_discount), 6) from lineitem""")
def profile_correlation(spark: SparkSession, d: str) -> DataFrame:
    found = M.profile_correlation(frame(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return _rounded(found, "correlation", places=6)


PART_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("\n    union all\n    ".join(
    f"select '{a}' as name, '{b}' as other, round(corr({a}, {b}), 3) + 0.0 as correlation from lineitem"
    for i, a in enumerate(PART_NUMBERS) for b in PART_NUMBERS[i + 1 :]))
def correlation_all(spark: SparkSession, d: str) -> DataFrame:
    """All numeric columns, without being named."""
    found = _rounded(M.profile_correlation(frame(spark, d, "lineitem").select(*PART_NUMBERS)), "correlation")
    return found.withColumn("correlation", F.col("correlation") + 0.0)  # a rounded -0.0 is 0.0



@query("""
    with t as (select case when event_id % 11 = 0 then null else value end as v,
                      event_id % 11 <> 0 and event_id % 13 = 0 and value is not null as far from events)
    select 'value' as name, count(v) as value_count, count(*) - count(v) as missing_count,
           round(avg(case when not far then v end), 3) as mean,
           round(stddev_samp(case when not far then v end), 3) as standard_deviation
    from t""")
def profile_nan(spark: SparkSession, d: str) -> DataFrame:
    """NaN counts as missing, and infinities stay out of the moments."""
    odd = F.when(F.col("event_id") % 11 == 0, float("nan")).when(F.col("value").isNotNull() & (F.col("event_id") % 13 == 0), float("inf"))
    rows = frame(spark, d, "events").select(odd.otherwise(F.col("value")).alias("value"))
    found = M.profile_numeric(rows, ["value"]).drop("minimum", "maximum")
    return _rounded(found, "mean", "standard_deviation")


@query("""
    with n as (select distinct l_extendedprice as value from lineitem where l_extendedprice is not null)
    select 'low' as side, value from (select value from n order by value limit 50) a
    union all select 'high', value from (select value from n order by value desc limit 50) b""")
def profile_extremes(spark: SparkSession, d: str) -> DataFrame:
    row = M.profile(frame(spark, d, "lineitem").select("l_extendedprice"), ["l_extendedprice"])
    sides = {"low": "minimumValues", "high": "maximumValues"}
    low, high = (row.select(F.lit(n).alias("side"), F.explode(c).alias("value")) for n, c in sides.items())
    return low.unionByName(high)


def _reports(spark: SparkSession, d: str) -> str:
    """Reports of three runs, each over the orders known by then."""
    path = scratch_path(spark, "reports")
    orders = frame(spark, d, "orders")
    for year in (1997, 1999, 2001):
        known = orders.where(F.col("o_orderdate") < F.lit(f"{year}-01-01").cast("timestamp_ntz"))
        R.write_report(M.profile(known, ["o_totalprice"]), path, "orders", datetime(year, 1, 1))
    return path


RUN = """
    select timestamp '{c}-01-01 00:00:00' as written_on, 'o_totalprice' as name, count(*) as size,
           round(min(o_totalprice), 2) as min, round(max(o_totalprice), 2) as max, round(avg(o_totalprice), 2) as mean,
           round(stddev_samp(o_totalprice), 2) as deviation
    from orders where o_orderdate < timestamp '{c}-01-01 00:00:00'"""


@query(_each(["1997", "1999", "2001"], RUN))
def read_reports(spark: SparkSession, d: str) -> DataFrame:
    rows = R.read_reports(spark, _reports(spark, d), "orders")
    rows = rows.withColumnRenamed("standardDeviation", "deviation")
    rows = rows.select("written_on", "name", "size", "min", "max", "mean", "deviation")
    return _rounded(rows, "min", "max", "mean", "deviation", places=2)


@query(_each(["1999", "2001"], RUN))
def consolidate_reports(spark: SparkSession, d: str) -> DataFrame:
    path = _reports(spark, d)
    reports = R.read_reports(spark, path, "orders", after=datetime(1998, 1, 1))
    _, short = R.consolidate_reports(reports, f"{path}/csv", "orders")
    columns = ", ".join(f"`{c}` string" for c in short.columns)
    text = spark.read.schema(columns).option("sep", ";").option("header", True).csv(f"{path}/csv/orders-short")
    return text.select(
        F.col("written_on").cast("timestamp"), "name", F.col("size").cast("long"),
        *[F.round(F.col(c).cast("double"), 2).alias(c) for c in ("min", "max", "mean")],
        F.round(F.col("standardDeviation").cast("double"), 2).alias("deviation"),
    )


@query("with runs as (" + _each(["1997", "1999", "2001"], RUN) + """)
    select written_on, name, mean, round(mean - lag(mean) over (order by written_on), 1) as mean_change from runs""")
def drift_series(spark: SparkSession, d: str) -> DataFrame:
    reports = R.read_reports(spark, _reports(spark, d), "orders")
    series = R.feature_series(reports, "o_totalprice", ["mean"])
    return _rounded(_rounded(series, "mean", places=2), "mean_change", places=1)


@query("""
    select user_id, event_time, event_type, value from (
        select *, row_number() over (partition by user_id order by event_time desc, api_invocation_time desc,
            write_time desc) as rn from {user_activity}) r
    where rn = 1 and not is_deleted""")
def fg_snapshot(spark: SparkSession, d: str) -> DataFrame:
    history, fg = with_group(spark, d, "user_activity")
    path = scratch_path(spark, "snapshot")
    latest(history, fg).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).select(*fg.names)


@query("""
    with t as (select order_id, purchase_amount from {order_facts} order by order_id limit 1000),
         b as (select avg(purchase_amount) as m, stddev_pop(purchase_amount) as s from t),
         n as (select count(*) as n from {order_facts})
    select concat('O', n + row_number() over (order by order_id) - 1) as order_id,
           round((purchase_amount - m) / s, 6) as purchase_amount from t, b, n""")
def drift_simulation(spark: SparkSession, d: str) -> DataFrame:
    orders, fg = with_group(spark, d, "order_facts")
    rows = M.drift_rows(orders.select("order_id", "purchase_amount"), fg, orders.count(), "purchase_amount")
    return _rounded(rows, "purchase_amount", places=6)


def _training(spark: SparkSession, d: str) -> DataFrame:
    joined = _star_join(
        frame(spark, d, "order_facts"),
        [
            (frame(spark, d, "customers"), "customer_id", "customer_id"),
            (frame(spark, d, "products"), "product_id", "product_id"),
        ],
    )
    joined = joined.withColumn("is_reordered", F.col("is_reordered").cast("int"))
    return joined.withColumn("is_married", F.col("is_married").cast("int"))


LEFT_OUT = [
    "order_id", "customer_id", "product_id", "event_time", "purchased_on", "purchase_amount", "active_since",
    "product_name", "c_mktsegment", "product_category",
]
MODEL_FEATURES = ["age", "sex", "is_married", "p_size", "p_retailprice"]


@query("""
    select cast(is_reordered as int) as is_reordered, age, sex, cast(is_married as int) as is_married, p_size, p_retailprice
    from {order_facts} o join {customers} c on o.customer_id = c.customer_id
    join {products} p on o.product_id = p.product_id""")
def training_set(spark: SparkSession, d: str) -> DataFrame:
    return N.training_set(_training(spark, d), "is_reordered", LEFT_OUT)


@query("""
    select order_id, case when rn < floor(0.7 * n) then 'train' when rn < floor(0.9 * n) then 'validation'
               else 'test' end as split
    from (select order_id, row_number() over (order by md5(concat_ws('-', order_id, 123))) - 1 as rn,
                 count(*) over () as n from {order_facts}) t""")
def split_70_20_10(spark: SparkSession, d: str) -> DataFrame:
    return N.split(frame(spark, d, "order_facts").select("order_id"), "order_id")


@query("""
    select order_id, true as scored from (
        select order_id, row_number() over (order by md5(concat_ws('-', order_id, 123))) - 1 as rn, count(*) over () as n
        from {order_facts} o join {customers} c on o.customer_id = c.customer_id
        join {products} p on o.product_id = p.product_id) t
    where rn >= floor(0.9 * n)""")
def train_score(spark: SparkSession, d: str) -> DataFrame:
    rows = _training(spark, d).select("order_id", "is_reordered", *MODEL_FEATURES)
    rows = durable(N.split(rows, "order_id"), "training")
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    model = N.train_classifier(train, "is_reordered", MODEL_FEATURES)
    scored = N.score(model, test.select("order_id", "is_reordered", *MODEL_FEATURES), MODEL_FEATURES)
    return scored.select("order_id", F.col("prediction_score").between(0, 1).alias("scored"))


@query("""
    select p_partkey, p_size / 50.0e0 as score,
           case when p_size / 50.0e0 < 0.5e0 then 'will not reorder' else 'will reorder' end as reorder,
           case when p_size / 50.0e0 < 0.65e0 then 'list price' else 'discount' end as discount
    from part""")
def score_threshold(spark: SparkSession, d: str) -> DataFrame:
    scored = frame(spark, d, "part").select("p_partkey", (F.col("p_size") / F.lit(50.0)).alias("score"))
    scored = N.decide(scored, "score", N.REORDER_THRESHOLD, "will not reorder", "will reorder", "reorder")
    return N.decide(scored, "score", N.DISCOUNT_THRESHOLD, "list price", "discount", "discount")


@query("""
    select b.customer_id, b.product_id, c.age, p.p_size,
           round(coalesce(c.age, 0) * 0.01e0 + coalesce(p.p_size, 0) * 0.02e0, 6) as prediction_score
    from (select distinct o_custkey as customer_id, l_partkey as product_id
          from orders join lineitem on o_orderkey = l_orderkey) b
    left join (select * from {customers} where not is_deleted) c on b.customer_id = c.customer_id
    left join (select * from {products} where not is_deleted) p on b.product_id = p.product_id""")
def lookup_then_score(spark: SparkSession, d: str) -> DataFrame:
    def load() -> dict[str, float]:
        return {"age": 0.01, "p_size": 0.02}

    def predict(weights: dict[str, float], batch: pd.DataFrame) -> pd.Series:
        return sum(batch[c].fillna(0).astype("float64") * w for c, w in weights.items())

    orders, lines = frame(spark, d, "orders"), frame(spark, d, "lineitem")
    pairs = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("product_id")
    )
    names = ("customers", "products")
    frames = {n: frame(spark, d, n) for n in names}
    groups = {n: group(n, f) for n, f in frames.items()}
    online = {n: materialized(frames[n], groups[n]) for n in names}
    found = _featureset(pairs.distinct(), ["customers:age", "products:p_size"], groups, online)
    return _rounded(N.score_foreign(found, load, predict, skip=2), "prediction_score", places=6)


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return durable(frame(spark, d, "lineage_edges"), "edges")  # an edge table, as a user would keep it


REACH = """
    with recursive r(node, kind, depth) as (
        select {far}, {far}_kind, 1 from {{lineage_edges}} where {near} = '{start}'
        union
        select e.{far}, e.{far}_kind, depth + 1 from r join {{lineage_edges}} e on e.{near} = r.node where depth < {limit})
    select node, kind, min(depth) as depth from r {where} group by node, kind"""


def _up(start: str, limit: int, kind: str) -> str:
    return REACH.format(far="src", near="dst", start=start, limit=limit, where=f"where kind = '{kind}'")


def _down(start: str, limit: int, kind: str) -> str:
    return REACH.format(far="dst", near="src", start=start, limit=limit, where=f"where kind = '{kind}'")


@query("""
    select src_kind, dst_kind, count(*) as edges from (
        select src_kind, dst_kind from {lineage_edges}
        union all select 'feature_group', 'training' union all select 'feature_group', 'training'
        union all select 'training', 'model' union all select 'model', 'endpoint') t
    group by src_kind, dst_kind""")
def lineage_edges(spark: SparkSession, d: str) -> DataFrame:
    run = O.training_run_edges(
        spark, "training/new", "model/new", ["fg/1", "fg/2"], endpoint="endpoint/new"
    )
    both = frame(spark, d, "lineage_edges").unionByName(run)
    return both.groupBy("src_kind", "dst_kind").agg(F.count(F.lit(1)).alias("edges"))


@query(_up("model/7", 2, "feature_group"))
def lineage_fg_of_model(spark: SparkSession, d: str) -> DataFrame:
    return O.groups_of_model(_edges(spark, d), "model/7", 2)


@query(_down("fg/7", 2, "model"))
def lineage_models_of_fg(spark: SparkSession, d: str) -> DataFrame:
    return O.models_of_group(_edges(spark, d), "fg/7", 2)


@query(_down("source/7", 3, "feature_group"))
def lineage_fg_of_source(spark: SparkSession, d: str) -> DataFrame:
    return O.groups_of_source(_edges(spark, d), "source/7", 3)


@query(_up("fg/7", 2, "source"))
def lineage_sources_of_fg(spark: SparkSession, d: str) -> DataFrame:
    return O.sources_of_group(_edges(spark, d), "fg/7", 2)


@query(REACH.format(far="src", near="dst", start="endpoint/7", limit=10, where=""))
def lineage_endpoint(spark: SparkSession, d: str) -> DataFrame:
    return O.connected(_edges(spark, d), "endpoint/7")


@query("""
    with recursive r(node, kind) as (
        select dst, dst_kind from {lineage_edges} where src = 'source/7'
        union
        select e.dst, e.dst_kind from r join {lineage_edges} e on e.src = r.node)
    select distinct node, kind from r""")
def lineage_unbounded(spark: SparkSession, d: str) -> DataFrame:
    """Everything downstream of a source, however far."""
    return O.reach(_edges(spark, d), "source/7", "down").select("node", "kind")


@query("""
    with recursive r(node, depth) as (
        select src, 1 from {lineage_edges} where dst = 'endpoint/7'
        union
        select e.src, depth + 1 from r join {lineage_edges} e on e.dst = r.node where depth < 2)
    select src_kind, dst_kind, count(*) as edges from {lineage_edges}
    where src not in (select node from r) and dst not in (select node from r) group by src_kind, dst_kind""")
def lineage_delete(spark: SparkSession, d: str) -> DataFrame:
    edges = _edges(spark, d)
    kept = O.delete_lineage(edges, O.connected(edges, "endpoint/7", max_depth=2))
    return kept.groupBy("src_kind", "dst_kind").agg(F.count(F.lit(1)).alias("edges"))


@query("""
    select 'order_facts' as feature_group, 'order_id' as feature_name, 'Integral' as feature_type, count(order_id) as n
    from {order_facts}
    union all select 'order_facts', 'product_id', 'Integral', count(product_id) from {order_facts}
    union all select 'order_facts', 'purchase_amount', 'Fractional', count(purchase_amount) from {order_facts}
    union all select 'order_facts', 'is_reordered', 'String', count(is_reordered) from {order_facts}
    union all select 'order_facts', 'event_time', 'String', count(event_time) from {order_facts}""")
def feature_definitions(spark: SparkSession, d: str) -> DataFrame:
    columns = ["order_id", "product_id", "purchase_amount", "is_reordered", "event_time"]
    rows = frame(spark, d, "order_facts").select(*columns)
    defined = definitions_frame(spark, [group("order_facts", rows)]).drop("collection_type")
    filled = rows.agg(*[F.count(c).alias(c) for c in columns]).unpivot([], columns, "feature_name", "n")
    return defined.join(filled, "feature_name")


def _catalog(spark: SparkSession, d: str) -> DataFrame:
    rows = frame(spark, d, "feature_catalog")
    return rows.withColumn("params", F.create_map(F.lit("team"), "team"))


CATALOG = ["feature_group", "feature_name", "feature_type", "description", "created_at"]


@query("""
    select feature_group, feature_name, feature_type, description, created_at from {feature_catalog}
    where (lower(feature_name) like '%ring%' or lower(description) like '%ring%' or team like '%ring%')
    union all
    select feature_group, feature_name, feature_type, description, created_at from {feature_catalog}
    where lower(description) like '%promo%' and created_at between timestamp '2024-01-05 00:00:00'
        and timestamp '2024-02-05 00:00:00' and team = 'large'""")
def feature_search(spark: SparkSession, d: str) -> DataFrame:
    catalog = _catalog(spark, d)
    anywhere = C.search(catalog, "RING")
    scoped = C.search(
        catalog, "promo", scope="description", created_from=datetime(2024, 1, 5), created_to=datetime(2024, 2, 5),
        param=("team", "large"),
    )
    return anywhere.select(*CATALOG).unionByName(scoped.select(*CATALOG))


@query("""
    select feature_group, count(*) as feature_count from {feature_catalog}
    where lower(feature_group) like '%#1%' group by feature_group""")
def catalog_list(spark: SparkSession, d: str) -> DataFrame:
    return C.list_groups(_catalog(spark, d), "brand#1")


@query("""
    select feature_name, case when p_size % 2 = 0 then 'checked' else description end as description,
           case when p_size % 2 = 0 then 'data' else team end as team
    from (select *, cast(extract(day from created_at - timestamp '2024-01-01 00:00:00') as int) as p_size
          from {feature_catalog} where feature_group = 'Brand#11') t""")
def catalog_describe(spark: SparkSession, d: str) -> DataFrame:
    """A description and a parameter set on some features and read back with the rest of the group."""
    catalog = _catalog(spark, d).where("feature_group = 'Brand#11'")
    even = catalog.where(F.dayofyear("created_at") % 2 == 1).withColumn("feature_group", F.lit("described"))
    odd = catalog.where(F.dayofyear("created_at") % 2 == 0)
    names = F.col("feature_name")
    one = even.withColumn("name", names).withColumn("feature_name", F.lit("feature"))
    one = C.describe_feature(one, "described", "feature", "checked", {"team": "data"}).withColumn("feature_name", F.col("name")).drop("name")
    return odd.unionByName(one).select("feature_name", "description", F.try_element_at("params", F.lit("team")).alias("team"))


@query("""
    select distinct feature_group, 'owner' as tag, case when feature_group = 'Brand#11' then 'new' else team end as value
    from {feature_catalog} where feature_group in ('Brand#11', 'Brand#12')
    union all select 'Brand#11', 'stage', 'live'""")
def catalog_tags(spark: SparkSession, d: str) -> DataFrame:
    rows = frame(spark, d, "feature_catalog").where("feature_group in ('Brand#11', 'Brand#12')")
    catalog = rows.withColumn("tags", F.create_map(F.lit("owner"), "team")).withColumn("group_description", F.lit(None).cast("string"))
    return C.group_tags(C.tag_group(catalog, "Brand#11", {"owner": "new", "stage": "live"}, "parts of brand 11"))
