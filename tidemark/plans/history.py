"""Latest, as-of, selections, counts and unions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import latest as L
from tidemark.operators import select as S
from tidemark.plans.fixtures import frame, group, with_group
from tidemark.plans.registry import query

NEWEST = "event_time desc nulls last, api_invocation_time desc nulls last, write_time desc nulls last"
ACTIVITY_TIES = "event_type desc nulls last, value desc nulls last, is_deleted desc nulls last"


@query(f"""
    select user_id, event_time, event_type, value, write_time, api_invocation_time, is_deleted from (
        select *, row_number() over (partition by user_id order by {NEWEST}, {ACTIVITY_TIES}) as rn
        from {{user_activity_dup}}) r
    where rn = 1 and not is_deleted""")
def latest_row_number(spark: SparkSession, d: str) -> DataFrame:
    return L.latest(*with_group(spark, d, "user_activity_dup"))


@query(f"""
    select user_id, event_time, event_type, value, write_time, api_invocation_time, is_deleted from (
        select *, dense_rank() over (partition by user_id order by {NEWEST}) as rk from {{user_activity_dup}}) r
    where rk = 1 and not is_deleted""")
def latest_dense_rank(spark: SparkSession, d: str) -> DataFrame:
    return L.latest(*with_group(spark, d, "user_activity_dup"), ties="all")


@query(f"""
    select user_id, event_time, event_type, value, write_time, api_invocation_time, is_deleted from (
        select *, dense_rank() over (partition by user_id order by {NEWEST}) as rk
        from {{user_activity_dup}} where not is_deleted) r
    where rk = 1""")
def latest_filter_first(spark: SparkSession, d: str) -> DataFrame:
    return L.latest(*with_group(spark, d, "user_activity_dup"), ties="all", deleted="before")


@query(f"""
    select user_id, event_time, event_type, value from (
        select *, row_number() over (partition by user_id
            order by event_time desc nulls last, {ACTIVITY_TIES}) as rn
        from {{user_activity}}) r
    where rn = 1""")
def latest_event_time_only(spark: SparkSession, d: str) -> DataFrame:
    return L.materialized(*with_group(spark, d, "user_activity"), mode="event_time_only")


@query("""
    select o_custkey, event_time, o_totalprice, o_orderstatus, write_time, api_invocation_time, is_deleted from (
        select *, row_number() over (partition by o_custkey order by event_time desc nulls last,
            api_invocation_time desc nulls last, write_time desc nulls last) as rn
        from {customer_history} where event_time <= timestamp '1999-06-30 00:00:00') r
    where rn = 1 and not is_deleted""")
def as_of_event_time(spark: SparkSession, d: str) -> DataFrame:
    return L.as_of(*with_group(spark, d, "customer_history"), "1999-06-30t00:00:00z")


@query("""
    select o_custkey, event_time, o_totalprice, o_orderstatus, write_time, api_invocation_time, is_deleted from (
        select *, row_number() over (partition by o_custkey order by event_time desc nulls last,
            api_invocation_time desc nulls last, write_time desc nulls last) as rn
        from {customer_history}) r
    where rn <= 3 and not is_deleted""")
def recent_n(spark: SparkSession, d: str) -> DataFrame:
    return L.recent(*with_group(spark, d, "customer_history"), 3)


@query("""
    select user_id, event_time, event_type, value from (
        select *, row_number() over (partition by user_id order by event_time desc, api_invocation_time desc,
            write_time desc) as rn from {user_activity}) r
    where rn = 1 and not is_deleted""")
def materialize_online(spark: SparkSession, d: str) -> DataFrame:
    return L.materialized(*with_group(spark, d, "user_activity"))


@query("select user_id, value, event_type from {user_activity}")
def project_features(spark: SparkSession, d: str) -> DataFrame:
    return S.select_features(frame(spark, d, "user_activity"), ["user_id", "value", "event_type"])


@query("select user_id, event_time, event_type, value from {user_activity}")
def drop_system_cols(spark: SparkSession, d: str) -> DataFrame:
    return L.drop_system(frame(spark, d, "user_activity"))


@query("""
    select is_reordered, age, sex, is_married, c_mktsegment
    from {order_facts} o join (select customer_id as k, age, sex, is_married, c_mktsegment from {customers}) c
      on o.customer_id = c.k""")
def feature_exclusion(spark: SparkSession, d: str) -> DataFrame:
    orders, customers = frame(spark, d, "order_facts"), frame(spark, d, "customers")
    groups = [group("order_facts", orders), group("customers", customers)]
    exclude = ["order_id", "customer_id", "product_id", "event_time", "purchase_amount", "purchased_on", "active_since"]
    joined = orders.join(customers.drop("event_time", "write_time", "api_invocation_time", "is_deleted"), "customer_id")
    return S.without_features(joined, groups, exclude)


@query("""
    select o_custkey, event_time, o_totalprice, o_orderstatus from {customer_history}
    where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')""")
def filter_ids(spark: SparkSession, d: str) -> DataFrame:
    history, fg = with_group(spark, d, "customer_history")
    ids = frame(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    return L.by_ids(history, fg.record_id, ids).select(*fg.names)


@query("""
    select o_custkey, event_time, o_totalprice from {customer_history}
    where event_time between timestamp '1996-02-01 00:00:00' and timestamp '1998-02-01 00:00:00'""")
def event_time_range(spark: SparkSession, d: str) -> DataFrame:
    history, fg = with_group(spark, d, "customer_history")
    rows = L.event_time_range(history, fg, datetime(1996, 2, 1), datetime(1998, 2, 1))
    return rows.select("o_custkey", "event_time", "o_totalprice")


@query("""
    select o_custkey, event_time, o_totalprice from {customer_history}
    where write_time <= timestamp '1998-02-01 00:00:00'""")
def as_of_write_time(spark: SparkSession, d: str) -> DataFrame:
    history = frame(spark, d, "customer_history")
    return L.rows_as_of_write_time(history, datetime(1998, 2, 1)).select("o_custkey", "event_time", "o_totalprice")


@query("select order_id, event_time, product_id from {order_facts} where product_id is not null")
def new_feature_not_null(spark: SparkSession, d: str) -> DataFrame:
    return S.where_present(frame(spark, d, "order_facts"), "product_id").select("order_id", "event_time", "product_id")


@query("select is_reordered, order_id, customer_id, product_id, purchase_amount from {order_facts}")
def label_first(spark: SparkSession, d: str) -> DataFrame:
    orders = frame(spark, d, "order_facts")
    return S.label_first(
        orders.select("order_id", "customer_id", "product_id", "purchase_amount", "is_reordered"), "is_reordered"
    )


@query("""
    select user_id, event_time, event_type, value, write_time, api_invocation_time, is_deleted
    from {user_activity} where user_id = 46 and event_type = 'view' order by event_time""")
def record_history(spark: SparkSession, d: str) -> DataFrame:
    history, fg = with_group(spark, d, "user_activity")
    return S.historical(history, fg, [46]).where("event_type = 'view'").orderBy(fg.event_time)


@query("select o_custkey, o_totalprice, is_deleted from {customer_history}")
def historical_values(spark: SparkSession, d: str) -> DataFrame:
    history, fg = with_group(spark, d, "customer_history")
    return S.historical(history, fg, None, ["o_custkey", "o_totalprice", "is_deleted"])


@query("""
    select c_mktsegment, count(*) as order_count, round(sum(purchase_amount), 2) as amount
    from {order_facts} o join {customers} c on o.customer_id = c.customer_id
    where not o.is_deleted group by c_mktsegment""")
def sql_over_views(spark: SparkSession, d: str) -> DataFrame:
    frames = {"order-facts": frame(spark, d, "order_facts"), "order": frame(spark, d, "customers")}
    return S.query(
        frames,
        """select c_mktsegment, count(*) as order_count, round(sum(purchase_amount), 2) as amount
           from order_facts o join `order` c on o.customer_id = c.customer_id
           where not o.is_deleted group by c_mktsegment""",
    )


@query("select count(*) as record_count from {customer_history}")
def record_count(spark: SparkSession, d: str) -> DataFrame:
    return S.record_count(frame(spark, d, "customer_history"))


@query("""
    select min(write_time) as min_write_time, max(write_time) as max_write_time,
           min(event_time) as min_event_time, max(event_time) as max_event_time from {customer_history}""")
def minmax_timestamps(spark: SparkSession, d: str) -> DataFrame:
    return S.minmax_timestamps(*with_group(spark, d, "customer_history"))


@query("""
    select 'customers' as feature_group, count(*) as record_count, cast(100 as bigint) as expected,
           count(*) >= 100 as available from {customers}
    union all
    select 'products', count(*), cast(1000000000000 as bigint), count(*) >= 1000000000000 from {products}
    union all
    select 'order_facts', count(*), cast(1000 as bigint), count(*) >= 1000 from {order_facts}""")
def availability(spark: SparkSession, d: str) -> DataFrame:
    expected = {"customers": 100, "products": 1_000_000_000_000, "order_facts": 1000}
    return S.availability({n: frame(spark, d, n) for n in expected}, expected)


@query("""
    select concat(year(o_orderdate), '-', month(o_orderdate)) as year_month, count(*) as record_count
    from orders group by 1""")
def month_counts(spark: SparkSession, d: str) -> DataFrame:
    return S.month_counts(frame(spark, d, "orders"), "o_orderdate")


@query("""
    select order_id, write_time, purchase_amount from {order_facts}
    order by write_time desc nulls last, order_id limit 1000""")
def recent_writes_topk(spark: SparkSession, d: str) -> DataFrame:
    return S.recent_writes(*with_group(spark, d, "order_facts")).select("order_id", "write_time", "purchase_amount")


@query("""
    select order_id, purchase_amount from {order_facts}
    where substr(md5(concat(order_id, ':7')), 1, 8) < '0ccccccc'
    order by md5(concat(order_id, ':7')) limit 500""")
def bernoulli_sample(spark: SparkSession, d: str) -> DataFrame:
    sample = S.bernoulli_sample(*with_group(spark, d, "order_facts"), percent=5.0, n=500, seed=7)
    return sample.select("order_id", "purchase_amount")


@query("""
    select user_id, max(event_time) as event_time from {user_activity}
    where event_time <= timestamp '2024-01-15 00:30:00' group by user_id""")
def as_of_offset(spark: SparkSession, d: str) -> DataFrame:
    """A bound with an offset is an instant: 02:30 at +02:00 is half past midnight."""
    history, fg = with_group(spark, d, "user_activity")
    found = L.as_of(history, fg, "2024-01-15T02:30:00+02:00", deleted="ignore")
    return found.select("user_id", "event_time")


@query("select date_trunc('second', max(write_time)) as cutoff from {user_activity}")
def write_time_cutoff(spark: SparkSession, d: str) -> DataFrame:
    return S.write_time_cutoff(frame(spark, d, "user_activity"))


@query("""
    select user_id, event_time, event_type, value from {user_activity}
    union all select user_id, event_time, event_type, value from {user_activity_dup}""")
def union_history(spark: SparkSession, d: str) -> DataFrame:
    a = frame(spark, d, "user_activity").select("user_id", "event_time", "event_type", "value")
    b = frame(spark, d, "user_activity_dup").select("value", "event_type", "event_time", "user_id")
    return S.union_history(a, b)


@query("""
    select order_id, purchase_amount, null as has_kids from {order_facts} where event_time < timestamp '1998-01-01'
    union all
    select order_id, purchase_amount, order_id % 2 = 0 from {order_facts} where event_time >= timestamp '1998-01-01'""")
def union_schema_evolution(spark: SparkSession, d: str) -> DataFrame:
    rows = frame(spark, d, "order_facts").select("order_id", "purchase_amount", "event_time")
    change = F.lit("1998-01-01").cast("timestamp_ntz")
    old = rows.where(F.col("event_time") < change).drop("event_time")
    new = rows.where(F.col("event_time") >= change).drop("event_time")
    return S.union_history(old, new.withColumn("has_kids", F.col("order_id") % 2 == 0), evolve=True)
