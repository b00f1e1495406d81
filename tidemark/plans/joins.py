"""Star joins, point-in-time joins, the dataset builder and lookups."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.records import to_records
from tidemark.operators import dataset as D
from tidemark.operators import pit as P
from tidemark.operators.access import cell_filter as _cell
from tidemark.operators.access import column_filter as _column
from tidemark.operators.access import row_filter as _row
from tidemark.operators.latest import latest, materialized
from tidemark.operators.select import get_record as _get_record
from tidemark.plans.fixtures import frame, group, with_group
from tidemark.plans.registry import query

PURCHASES_PIT = """
    left join lateral (
        select event_type, value, is_deleted from {user_activity} f
        where f.user_id = e.user_id and f.event_time <= e.ts
        order by event_time desc, write_time desc nulls last, event_type desc nulls last, value desc nulls last,
                 is_deleted desc limit 1) f on true"""


@query("""
    select order_id, o.customer_id, o.product_id, purchase_amount, age, c_mktsegment, product_category, p_retailprice
    from {order_facts} o, {customers} c, {products} p
    where o.customer_id = c.customer_id and o.product_id = p.product_id""")
def star_join(spark: SparkSession, d: str) -> DataFrame:
    joined = D.star_join(
        frame(spark, d, "order_facts"),
        [
            (frame(spark, d, "customers"), "customer_id", "customer_id"),
            (frame(spark, d, "products"), "product_id", "product_id"),
        ],
    )
    return joined.select(
        "order_id", "customer_id", "product_id", "purchase_amount", "age", "c_mktsegment", "product_category",
        "p_retailprice",
    )


@query("""
    with o as (select *, dense_rank() over (partition by order_id order by event_time desc, api_invocation_time desc,
                  write_time desc) as rk from {order_facts} where not is_deleted),
         c as (select *, dense_rank() over (partition by customer_id order by event_time desc,
                  api_invocation_time desc, write_time desc) as rk from {customers} where not is_deleted),
         p as (select *, dense_rank() over (partition by product_id order by event_time desc,
                  api_invocation_time desc, write_time desc) as rk from {products} where not is_deleted)
    select distinct order_id, is_reordered, age, sex, c_mktsegment, product_category, p_size
    from o join c on o.customer_id = c.customer_id join p on o.product_id = p.product_id
    where o.rk = 1 and c.rk = 1 and p.rk = 1""")
def latest_star_join(spark: SparkSession, d: str) -> DataFrame:
    return D.latest_star_join(
        with_group(spark, d, "order_facts"),
        [
            (*with_group(spark, d, "customers"), "customer_id"),
            (*with_group(spark, d, "products"), "product_id"),
        ],
        ["order_id", "is_reordered", "age", "sex", "c_mktsegment", "product_category", "p_size"],
    )


@query(f"""
    select e.event_id, e.user_id, e.ts,
           case when not f.is_deleted then f.event_type end as event_type,
           case when not f.is_deleted then f.value end as value
    from {{purchases}} e {PURCHASES_PIT}""")
def pit_join(spark: SparkSession, d: str) -> DataFrame:
    history, fg = with_group(spark, d, "user_activity")
    return P.pit_join(frame(spark, d, "purchases"), "ts", fg, history)


@query(f"""
    select count(*) as spine_rows, count(distinct e.event_id) as spine_ids,
           count(case when not f.is_deleted then f.value end) as rows_with_features
    from {{purchases}} e {PURCHASES_PIT}""")
def pit_left_preserve(spark: SparkSession, d: str) -> DataFrame:
    history, fg = with_group(spark, d, "user_activity")
    found = P.pit_join(frame(spark, d, "purchases"), "ts", fg, history)
    return found.agg(
        F.count(F.lit(1)).alias("spine_rows"),
        F.countDistinct("event_id").alias("spine_ids"),
        F.count("value").alias("rows_with_features"),
    )


@query("""
    select e.order_id, e.customer_id, e.product_id, e.event_time,
           case when not h.is_deleted then h.o_totalprice end as o_totalprice,
           case when not s.is_deleted then s.l_quantity end as l_quantity,
           case when not s.is_deleted then s.l_extendedprice end as l_extendedprice,
           case when not p.is_deleted then p.o_orderpriority end as o_orderpriority
    from {order_facts} e
    left join lateral (select o_totalprice, is_deleted from {customer_history} f
        where f.o_custkey = e.customer_id and f.event_time <= e.event_time
        order by f.event_time desc, write_time desc, o_totalprice desc nulls last, is_deleted desc limit 1) h on true
    left join lateral (select l_quantity, l_extendedprice, is_deleted from {part_sales} f
        where f.l_partkey = e.product_id and f.event_time <= e.event_time
        order by f.event_time desc, write_time desc, l_quantity desc nulls last, l_extendedprice desc nulls last,
                 is_deleted desc limit 1) s on true
    left join lateral (select o_orderpriority, is_deleted from {customer_priority} f
        where f.o_custkey = e.customer_id and f.event_time <= e.event_time
        order by f.event_time desc, write_time desc, o_orderpriority desc nulls last, is_deleted desc limit 1) p
        on true""")
def pit_multi_group(spark: SparkSession, d: str) -> DataFrame:
    names = ("customer_history", "part_sales", "customer_priority")
    histories = {n: frame(spark, d, n) for n in names}
    spine = frame(spark, d, "order_facts").select("order_id", "customer_id", "product_id", "event_time")
    return P.get_features(
        spine,
        "event_time",
        ["customer_history:o_totalprice", "part_sales:*", "customer_priority:o_orderpriority"],
        {n: group(n, h) for n, h in histories.items()},
        histories,
        keys={"customer_history": "customer_id", "customer_priority": "customer_id", "part_sales": "product_id"},
    )


@query("""
    select order_id, customer_id, o_totalprice, o_orderstatus from {order_facts} b
    join {customer_history} h on b.customer_id = h.o_custkey""")
def builder_join_fg(spark: SparkSession, d: str) -> DataFrame:
    orders, base = with_group(spark, d, "order_facts")
    history, fg = with_group(spark, d, "customer_history")
    dataset = D.create_dataset(orders.select("order_id", "customer_id", "event_time"), fg=base).with_feature_group(
        fg, history, "customer_id", ["o_totalprice", "o_orderstatus"]
    )
    return dataset.to_dataframe().drop("event_time")


@query("""
    select event_id, e.user_id, ts, h.event_type from {purchases} e
    join {user_activity} h on e.user_id = h.user_id
    where ts between timestamp '2024-01-05 00:00:00' and timestamp '2024-01-20 00:00:00'
      and h.event_time between timestamp '2024-01-05 00:00:00' and timestamp '2024-01-20 00:00:00'
      and h.write_time <= timestamp '2024-01-18 12:00:00'""")
def builder_join_df(spark: SparkSession, d: str) -> DataFrame:
    history, fg = with_group(spark, d, "user_activity")
    dataset = (
        D.create_dataset(frame(spark, d, "purchases"), "user_id", "ts")
        .with_feature_group(fg, history, "user_id", ["event_type"])
        .with_event_time_range(datetime(2024, 1, 5), datetime(2024, 1, 20))
        .as_of(datetime(2024, 1, 18, 12))
    )
    return dataset.to_dataframe()


@query("""
    with ranked as (
        select e.event_id, e.user_id, e.ts, f.event_type, f.value, f.is_deleted,
               row_number() over (partition by e.event_id order by f.event_time desc, f.write_time desc,
                   f.event_type desc nulls last, f.value desc nulls last, f.is_deleted desc) as rn
        from {purchases} e join {user_activity} f on f.user_id = e.user_id and f.event_time <= e.ts)
    select event_id, user_id, ts, event_type, value from ranked where rn <= 3 and not is_deleted""")
def builder_pit_n_recent(spark: SparkSession, d: str) -> DataFrame:
    history, fg = with_group(spark, d, "user_activity")
    dataset = (
        D.create_dataset(frame(spark, d, "purchases"), "user_id", "ts")
        .with_feature_group(fg, history, "user_id", ["event_type", "value"])
        .point_in_time_accurate_join()
        .with_number_of_recent_records_by_record_identifier(3)
    )
    return dataset.to_dataframe()


@query("""
    select user_id, event_time, event_type, value from (
        select *, row_number() over (partition by user_id order by event_time desc, api_invocation_time desc,
            write_time desc) as rn from {user_activity}) r
    where rn = 1 and not is_deleted and user_id in (select o_custkey from orders where o_orderstatus = 'F')""")
def batch_get(spark: SparkSession, d: str) -> DataFrame:
    history, fg = with_group(spark, d, "user_activity")
    ids = frame(spark, d, "orders").where("o_orderstatus = 'F'").select("o_custkey")
    return D.batch_get(materialized(history, fg), fg, ids)


@query("""
    with act as (select * from (select *, row_number() over (partition by user_id order by event_time desc,
            api_invocation_time desc, write_time desc) as rn from {user_activity}) r where rn = 1 and not is_deleted),
         cus as (select * from {customers} where not is_deleted)
    select i.user_id, i.customer_id, act.value, cus.age, cus.sex, act.event_type
    from (select distinct o_custkey as user_id, o_custkey as customer_id from orders) i
    left join act on act.user_id = i.user_id left join cus on cus.customer_id = i.customer_id""")
def latest_featureset(spark: SparkSession, d: str) -> DataFrame:
    names = ("user_activity", "customers")
    frames = {n: frame(spark, d, n) for n in names}
    groups = {n: group(n, f) for n, f in frames.items()}
    online = {n: materialized(frames[n], groups[n]) for n in names}
    ids = frame(spark, d, "orders").select(F.col("o_custkey").alias("user_id")).distinct()
    ids = ids.withColumn("customer_id", F.col("user_id"))
    features = ["user_activity:value", "customers:age", "customers:sex", "user_activity:event_type"]
    return D.latest_featureset(ids, features, groups, online)


@query("""
    select b.customer_id, b.product_id,
           concat_ws(',', cast(age as varchar), cast(sex as varchar), cast(p_size as varchar), product_category) as payload
    from (select distinct o_custkey as customer_id, l_partkey as product_id
          from orders join lineitem on o_orderkey = l_orderkey) b
    join {customers} c on b.customer_id = c.customer_id join {products} p on b.product_id = p.product_id""")
def basket_cross_join(spark: SparkSession, d: str) -> DataFrame:
    orders, lines = frame(spark, d, "orders"), frame(spark, d, "lineitem")
    baskets = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("product_id")
    )
    return D.basket_vectors(
        baskets.distinct(),
        frame(spark, d, "customers"), "customer_id", ["age", "sex"],
        frame(spark, d, "products"), "product_id", ["p_size", "product_category"],
    )


@query("""
    select o.order_id, o.customer_id, o.event_time, c.customer_id as customer_id_1, c.event_time as event_time_1,
           p.product_id, p.event_time as event_time_2
    from {order_facts} o join {customers} c on o.customer_id = c.customer_id
    join {products} p on o.product_id = p.product_id""")
def join_suffix(spark: SparkSession, d: str) -> DataFrame:
    joined = D.star_join(
        frame(spark, d, "order_facts").select("order_id", "customer_id", F.col("product_id").alias("bought"), "event_time"),
        [
            (frame(spark, d, "customers").select("customer_id", "event_time"), "customer_id", "customer_id"),
            (frame(spark, d, "products").select("product_id", "event_time"), "bought", "product_id"),
        ],
    )
    return joined.drop("bought")


@query("""
    select user_id, event_time, event_type, value, is_deleted from (
        select *, row_number() over (partition by user_id order by event_time desc, api_invocation_time desc,
            write_time desc) as rn from {user_activity}) r
    where rn = 1 and not is_deleted and user_id = 46""")
def get_record(spark: SparkSession, d: str) -> DataFrame:
    history, fg = with_group(spark, d, "user_activity")
    return _get_record(latest(history, fg), fg, 46, [*fg.names, "is_deleted"])


@query("select order_id, event_time, o_custkey from (select order_id, event_time, customer_id as o_custkey, "
       "product_id from {order_facts}) t")
def wildcard_features(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.model import FeatureGroup, parse_features

    rows = frame(spark, d, "order_facts").select("order_id", "event_time", F.col("customer_id").alias("o_custkey"))
    fg = FeatureGroup.from_frame("orders", rows, "order_id", "event_time")
    return rows.select("order_id", "event_time", *[f for _, f in parse_features(["orders:*"], {"orders": fg})])


@query("""
    select cast(record_id as bigint) as record_id, feature_name, value_as_string from (
        select customer_id as record_id, 'customer_id' as feature_name, cast(customer_id as varchar) as value_as_string
        from {customers}
        union all select customer_id, 'age', cast(age as varchar) from {customers}
        union all select customer_id, 'c_mktsegment', c_mktsegment from {customers}) t""")
def records_long(spark: SparkSession, d: str) -> DataFrame:
    from tidemark.functions.records import records_long as melt
    from tidemark.model import FeatureGroup

    rows = frame(spark, d, "customers").select("customer_id", "age", "c_mktsegment")
    return melt(to_records(rows, FeatureGroup.from_frame("customers", rows, "customer_id", "customer_id")))


@query("select customer_id, event_time, purchase_amount from {order_facts} where customer_id = 77")
def row_filter(spark: SparkSession, d: str) -> DataFrame:
    return _row(frame(spark, d, "order_facts"), "customer_id = 77").select(
        "customer_id", "event_time", "purchase_amount"
    )


@query("select customer_id, event_time, age, active_since, c_mktsegment from {customers}")
def column_filter(spark: SparkSession, d: str) -> DataFrame:
    hidden = ["sex", "is_married", "write_time", "api_invocation_time", "is_deleted"]
    return _column(frame(spark, d, "customers"), exclude=hidden)


@query("select customer_id, event_time, age, c_mktsegment from {customers} where sex = 1 and is_married")
def cell_filter(spark: SparkSession, d: str) -> DataFrame:
    return _cell(
        frame(spark, d, "customers"), "sex = 1 and is_married",
        include=["customer_id", "event_time", "age", "c_mktsegment", "sex", "is_married"], exclude=["sex", "is_married"],
    )
