"""Feature groups over the benchmark tables.

Each is one SELECT whose text both Spark and a SQL oracle run. ``{table}`` is
replaced by the table, and one group may build on another.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tidemark.model import FeatureGroup

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "labels")

FRAMES = {
    # Ties on the hour are broken by the system times; some newest rows are markers.
    "user_activity": """
        select user_id, date_trunc('hour', ts) as event_time,
               case when marked then null else event_type end as event_type,
               case when marked then null else value end as value,
               ts + interval '5' minute as write_time, ts as api_invocation_time, marked as is_deleted
        from (select *, event_type = 'error' and event_id % 10 = 0 as marked from {events}) e
        where event_type <> 'purchase'""",
    # Every click was sent twice at the same times, with another value: full ties.
    "user_activity_dup": """
        select * from {user_activity}
        union all
        select user_id, event_time, event_type, value + 1 as value, write_time, api_invocation_time, is_deleted
        from {user_activity} where event_type = 'click'""",
    "customer_history": """
        select o_custkey, o_orderdate as event_time,
               case when o_orderkey % 37 = 0 then null else o_totalprice end as o_totalprice,
               case when o_orderkey % 37 = 0 then null else o_orderstatus end as o_orderstatus,
               o_orderdate + o_orderkey * interval '1' second + interval '1' hour as write_time,
               o_orderdate + o_orderkey * interval '1' second as api_invocation_time,
               o_orderkey % 37 = 0 as is_deleted
        from {orders}""",
    "customer_priority": """
        select o_custkey, o_orderdate - interval '10' day as event_time, o_orderpriority,
               o_orderdate + o_orderkey * interval '1' second as write_time,
               o_orderdate + o_orderkey * interval '1' second as api_invocation_time,
               o_orderkey % 41 = 0 as is_deleted
        from {orders}""",
    "part_sales": """
        select l_partkey, l_shipdate as event_time, l_quantity, l_extendedprice,
               l_shipdate + interval '2' hour as write_time,
               l_shipdate + interval '1' hour as api_invocation_time,
               l_returnflag = 'R' and l_quantity < 5 as is_deleted
        from {lineitem}""",
    "customers": """
        select c_custkey as customer_id, timestamp '2024-01-01 00:00:00' as event_time,
               cast(18 + c_custkey % 74 as int) as age, cast(c_custkey % 2 as int) as sex,
               c_custkey % 3 = 0 as is_married,
               cast(date '2016-01-01' + cast(c_custkey % 1400 as int) as date) as active_since, c_mktsegment,
               timestamp '2024-01-01 02:00:00' as write_time,
               timestamp '2024-01-01 01:00:00' as api_invocation_time, c_custkey % 50 = 7 as is_deleted
        from {customer}""",
    "products": """
        select p_partkey as product_id, timestamp '2024-01-01 00:00:00' as event_time, p_name as product_name,
               lower(p_type) as product_category, p_size, p_retailprice,
               timestamp '2024-01-01 02:00:00' as write_time,
               timestamp '2024-01-01 01:00:00' as api_invocation_time, p_size = 50 as is_deleted
        from {part}""",
    "order_facts": """
        select o_orderkey as order_id, o_custkey as customer_id, product_id, o_orderdate as event_time,
               o_totalprice as purchase_amount, o_orderkey % 3 <> 0 as is_reordered, o_orderdate as purchased_on,
               o_orderdate + interval '1' hour as write_time, o_orderdate as api_invocation_time,
               o_orderstatus = 'P' as is_deleted
        from {orders} o
        left join (select l_orderkey, min(l_partkey) as product_id from {lineitem} group by l_orderkey) l
          on o_orderkey = l_orderkey""",
    "purchases": """
        select event_id, user_id, ts from {events} where event_type = 'purchase'""",
    # Supplier -> returns desk -> part -> order -> customer -> nation, as lineage edges.
    "lineage_edges": """
        select distinct concat('source/', s) as src, 'source' as src_kind,
               concat('processing/', s, '/', f) as dst, 'processing' as dst_kind
        from (select l_suppkey as s, l_returnflag as f from {lineitem}) a
        union all
        select distinct concat('processing/', s, '/', f), 'processing', concat('fg/', p), 'feature_group'
        from (select l_suppkey as s, l_returnflag as f, l_partkey as p from {lineitem}) b
        union all
        select distinct concat('fg/', p), 'feature_group', concat('training/', o), 'training'
        from (select l_partkey as p, l_orderkey as o from {lineitem}) c
        union all
        select concat('training/', o_orderkey), 'training', concat('model/', o_custkey), 'model' from {orders}
        union all
        select concat('model/', c_custkey), 'model', concat('endpoint/', c_nationkey), 'endpoint' from {customer}""",
    # One catalog row per part: brands play the groups, part keys the features.
    "feature_catalog": """
        select p_brand as feature_group, concat(p_name, ' ', p_partkey) as feature_name,
               case when p_size > 25 then 'Integral' else 'String' end as feature_type,
               case when p_size % 2 = 0 then concat('a ', p_type, ' product') else null end as description,
               case when p_size < 10 then 'small' else 'large' end as team,
               timestamp '2024-01-01 00:00:00' + p_size * interval '1' day as created_at
        from {part}""",
}

KEYS = {
    "user_activity": ("user_id", "event_time"),
    "user_activity_dup": ("user_id", "event_time"),
    "customer_history": ("o_custkey", "event_time"),
    "customer_priority": ("o_custkey", "event_time"),
    "part_sales": ("l_partkey", "event_time"),
    "customers": ("customer_id", "event_time"),
    "products": ("product_id", "event_time"),
    "order_facts": ("order_id", "event_time"),
}

_NAME = re.compile(r"\{(\w+)\}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table or a derived frame."""
    if name not in FRAMES:
        return table(spark, sf_dir, name)
    text = FRAMES[name]
    return spark.sql(text, **{n: frame(spark, sf_dir, n) for n in dict.fromkeys(_NAME.findall(text))})


def group(name: str, df: DataFrame) -> FeatureGroup:
    return FeatureGroup.from_frame(name, df, *KEYS[name])


def with_group(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, FeatureGroup]:
    df = frame(spark, sf_dir, name)
    return df, group(name, df)


def oracle(body: str) -> str:
    """SQL for the oracle: ``{name}`` in the body refers to a frame, defined in a WITH clause."""
    ctes: dict[str, str] = {}

    def need(text: str) -> None:
        for name in dict.fromkeys(_NAME.findall(text)):
            if name in FRAMES and name not in ctes:
                need(FRAMES[name])
                ctes[name] = _NAME.sub(r"\1", FRAMES[name])

    need(body)
    plain = _NAME.sub(r"\1", body).strip()
    defined = ",\n".join(f"{n} as ({t})" for n, t in ctes.items())
    if not defined:
        return plain
    if plain.lower().startswith("with recursive"):
        return f"with recursive {defined},\n{plain[len('with recursive'):]}"
    if plain.lower().startswith("with "):
        return f"with {defined},\n{plain[len('with '):]}"
    return f"with {defined}\n{plain}"
