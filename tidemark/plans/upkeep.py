"""State of streams, incremental materialisation, layouts for lookups, and maintenance of stored groups."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.transforms import row_positions
from tidemark.model import FeatureGroup
from tidemark.operators import ingest as I
from tidemark.operators.compact import compact_binpack as binpack
from tidemark.operators.compact import stored_files
from tidemark.operators.dataset import stored_get
from tidemark.operators.materialize import materialize_since
from tidemark.operators import profile_state as PS
from tidemark.operators.flow import run_document
from tidemark.operators.lineage import reach
from tidemark.operators.pit import pit_join
from tidemark.plans.fixtures import frame, with_group
from tidemark.plans.registry import query
from tidemark.session import durable, scratch_path
from tidemark.sources import files as S
from tidemark.sources.layout import write_bucketed, write_clustered
from tidemark.sources.reports import read_reports_variant, write_report
from tidemark.streaming.ingest import file_stream, ingest_stream, read_ingested
from tidemark.streaming.state import upsert_stream

EVENTS_CSV = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]
WRITTEN = datetime(2024, 3, 1)
BOUNDS = [datetime(2000, 1, 1), datetime(2024, 1, 11), datetime(2024, 1, 21), datetime(2100, 1, 1)]


def _state_run(spark: SparkSession, d: str, order: list[int], **options) -> tuple[DataFrame, FeatureGroup]:
    """Thirds of the events by time arrive in some order, each drained in a run of its own, the last one twice."""
    root = scratch_path(spark, "state")
    events = frame(spark, d, "events").select(*EVENT_COLUMNS)
    fg = FeatureGroup.from_frame("events", events, "user_id", "ts")
    for n in [*order, None]:
        if n is not None:
            part = events.where((F.col("ts") >= F.lit(BOUNDS[n])) & (F.col("ts") < F.lit(BOUNDS[n + 1])))
            S.write_csv(part, f"{root}/in/{n}", header=True)
        stream = file_stream(spark, f"{root}/in", EVENTS_CSV)
        upsert_stream(stream, fg, f"{root}/checkpoint", f"{root}/online", written=F.lit(WRITTEN), **options)
    return I.read_online(spark, f"{root}/online", fg), fg


@query("""
    select event_id, ts, user_id, event_type, value from (
        select *, row_number() over (partition by user_id order by ts desc) as rn from events) t where rn = 1""")
def stream_state_latest(spark: SparkSession, d: str) -> DataFrame:
    """The newest third comes before the middle one."""
    return _state_run(spark, d, [0, 2, 1])[0]


@query("""
    select user_id, ts, event_type from (
        select *, row_number() over (partition by user_id order by ts desc) as rn, max(ts) over () as last from events) t
    where rn = 1 and epoch_ms(ts) + 6 * 3600000 > epoch_ms(last) - 3600000""")
def stream_state_ttl(spark: SparkSession, d: str) -> DataFrame:
    """Users end six hours after their last event, measured by a watermark an hour behind the newest event."""
    return _state_run(spark, d, [0, 1, 2], ttl=timedelta(hours=6), delay="1 hour")[0].select("user_id", "ts", "event_type")


@query("select event_id, ts, user_id, event_type, value from events")
def stream_compact_replay(spark: SparkSession, d: str) -> DataFrame:
    """Drained, compacted, and drained again after the last commit was lost: no row comes twice."""
    root = scratch_path(spark, "replay")
    events = frame(spark, d, "events").select(*EVENT_COLUMNS)
    fg = FeatureGroup.from_frame("events", events, "user_id", "ts")
    S.write_csv(events.repartitionByRange(4, "ts"), f"{root}/in", header=True)

    def drain() -> None:
        stream = file_stream(spark, f"{root}/in", EVENTS_CSV, files_per_batch=1)
        ingest_stream(stream, fg, f"{root}/checkpoint", offline_path=f"{root}/offline", written=F.lit(WRITTEN))

    drain()
    for _ in range(2):
        I.compact_stream(spark, f"{root}/offline", ["year", "month", "day"])
        fs, commits = I.file_system(spark, f"{root}/checkpoint/commits")
        last = max((s.getPath() for s in fs.listStatus(commits) if s.getPath().getName().isdigit()), key=lambda p: int(p.getName()))
        fs.delete(last, False)
        drain()
    return read_ingested(spark, f"{root}/offline", EVENT_COLUMNS)


def _growing(spark: SparkSession, d: str, runs: int = 3) -> tuple[str, FeatureGroup, str]:
    """The activity history, appended in parts by write time, each followed by an incremental run."""
    history, fg = with_group(spark, d, "user_activity")
    root = scratch_path(spark, "growing")
    for n in range(runs):
        part = history.where((F.col("write_time") >= F.lit(BOUNDS[n])) & (F.col("write_time") < F.lit(BOUNDS[n + 1])))
        S.write_offline(part, fg, f"{root}/history", stamped=True, grain="month")
        materialize_since(spark, S.read_offline(spark, f"{root}/history"), fg, f"{root}/online")
    return root, fg, f"{root}/online"


@query("""
    select user_id, event_time, event_type, value from (
        select *, row_number() over (partition by user_id order by event_time desc, api_invocation_time desc,
            write_time desc) as rn from {user_activity}) r
    where rn = 1 and not is_deleted""")
def materialize_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Three runs over a growing history give what one over the whole would."""
    _, fg, online = _growing(spark, d)
    return I.read_online(spark, online, fg)


@query("select user_id, max(ts) as ts from events group by user_id")
def online_tiered(spark: SparkSession, d: str) -> DataFrame:
    """Sixteen small batches, merged by size classes as they come."""
    events = frame(spark, d, "events").select(*EVENT_COLUMNS)
    fg = FeatureGroup.from_frame("events", events, "user_id", "ts")
    path = scratch_path(spark, "tiered")
    for batch in range(16):
        rows = events.where(F.pmod("event_id", F.lit(16)) == batch)
        I.ingest(rows, fg, ["online"], online_path=path, batch=batch, writer="job", written=F.lit(WRITTEN))
        I.merge_tiers(spark, path, fg)
    return I.read_online(spark, path, fg, ["user_id", "ts"])


PIT_SQL = """
    select p.event_id, p.user_id, p.ts, a.event_type, a.value
    from {purchases} p asof left join (
        select user_id as k, event_time, case when is_deleted then null else event_type end as event_type,
               case when is_deleted then null else value end as value
        from (select *, row_number() over (partition by user_id, event_time order by write_time desc) as rn from {user_activity}) r
        where rn = 1) a
    on p.user_id = a.k and p.ts >= a.event_time"""


@query(PIT_SQL)
def pit_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """The history is bucketed by user and stays where it is."""
    history, fg = with_group(spark, d, "user_activity")
    name = f"activity_{uuid.uuid4().hex}"
    write_bucketed(history, fg, name, scratch_path(spark, "bucketed"), 16)
    purchases = frame(spark, d, "purchases")
    return pit_join(purchases, "ts", fg, spark.table(name), ["event_type", "value"], strategy="bucketed")


@query("""
    with years as (select year(event_time) as year, count(*) as n from {customer_history} group by all)
    select year, n, true as large_kept, true as fewer_files from years""")
def compact_binpack(spark: SparkSession, d: str) -> DataFrame:
    """Each year has one large file and a few small ones; only the small ones are merged."""
    history, fg = with_group(spark, d, "customer_history")
    path, names = scratch_path(spark, "binpack"), ["folder", "file", "bytes"]
    share = F.pmod(F.xxhash64("o_custkey", "event_time"), F.lit(20))
    for n in range(5):
        part = history.where(share == n if n < 4 else share >= 4)
        S.write_offline(part, fg, path, stamped=True, grain="year")
    before = stored_files(spark, path).select(*names).collect()
    largest = max(r["bytes"] for r in before)
    binpack(spark, path, target_bytes=largest, small=0.5)
    after = {r["file"] for r in stored_files(spark, path).select(*names).collect()}
    kept = all(r["file"] in after for r in before if r["bytes"] >= largest // 2)
    counts = spark.read.parquet(path).groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("year").cast("long").alias("year"), "n", F.lit(kept).alias("large_kept"), F.lit(len(after) < len(before)).alias("fewer_files"))


@query("""
    select user_id, event_time, event_type, value from (
        select *, row_number() over (partition by user_id order by event_time desc, api_invocation_time desc,
            write_time desc) as rn from {user_activity}) r
    where rn = 1 and not is_deleted and user_id in (select o_custkey from orders where o_orderstatus = 'F')""")
def batch_get_pruned(spark: SparkSession, d: str) -> DataFrame:
    """Ids looked up in files that hold ranges of ids, from three appends."""
    history, fg = with_group(spark, d, "user_activity")
    path = scratch_path(spark, "clustered")
    for n in range(3):
        part = history.where((F.col("write_time") >= F.lit(BOUNDS[n])) & (F.col("write_time") < F.lit(BOUNDS[n + 1])))
        write_clustered(part, fg, path, files=4)
    ids = frame(spark, d, "orders").where("o_orderstatus = 'F'").select("o_custkey")
    return stored_get(S.read_offline(spark, path), fg, ids)


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount"]


def _line_states(spark: SparkSession, d: str) -> DataFrame:
    """Line items stored by year of shipping: states after half of them, then after all."""
    lines, root = frame(spark, d, "lineitem"), scratch_path(spark, "states")
    lines = lines.withColumn("year", F.year("l_shipdate"))
    for early in (True, False):
        part = lines.where((F.col("year") < 1997) == early)
        part.hint("rebalance", "year").write.mode("append").partitionBy("year").parquet(f"{root}/lines")
        PS.update_states(spark, f"{root}/lines", f"{root}/states", LINE_NUMBERS)
    return PS.read_states(spark, f"{root}/lines", f"{root}/states", LINE_NUMBERS)


@query("\n    union all\n    ".join(f"""
    select '{c}' as name, count({c}) as value_count, count(*) - count({c}) as missing_count, min({c}) as minimum,
           max({c}) as maximum, round(avg({c}), 3) as mean, round(stddev_samp({c}), 3) as standard_deviation
    from lineitem""" for c in LINE_NUMBERS))
def profile_merged(spark: SparkSession, d: str) -> DataFrame:
    """Each half of the years is read once; the profile comes from the states."""
    found = PS.merged_profile(_line_states(spark, d))
    return found.withColumns({c: F.round(c, 3) for c in ("mean", "standard_deviation")})


@query("""
    select 'l_quantity' as name, 'l_extendedprice' as other, round(corr(l_quantity, l_extendedprice), 6) as correlation
    from lineitem
    union all select 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 6) from lineitem
    union all select 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, l_discount), 6) from lineitem""")
def correlation_merged(spark: SparkSession, d: str) -> DataFrame:
    return PS.merged_correlation(_line_states(spark, d)).withColumn("correlation", F.round("correlation", 6))


ORDERS_FLOW = {
    "nodes": [
        {"node_id": "scaled", "type": "TRANSFORM", "operator": "spark.scale_minmax_0.2", "parameters": {"columns": ["purchase_amount"], "decimals": 2}, "inputs": [{"node_id": "joined"}]},
        {"node_id": "joined", "type": "TRANSFORM", "operator": "spark.join_0.1", "parameters": {"on": "customer_id"}, "inputs": [{"node_id": "flagged"}, {"node_id": "customers"}]},
        {"node_id": "flagged", "type": "TRANSFORM", "operator": "spark.cast_single_data_type_0.1", "parameters": {"column": "is_reordered", "data_type": "long"}, "inputs": [{"node_id": "typed"}]},
        {"node_id": "typed", "type": "TRANSFORM", "operator": "spark.infer_and_cast_type_0.1", "parameters": {}, "trained_parameters": {"schema": {"order_id": "long", "customer_id": "long", "purchase_amount": "float", "is_reordered": "bool", "gone": "string"}}, "inputs": [{"node_id": "orders"}]},
        {"node_id": "orders", "type": "SOURCE", "operator": "csv_source_0.1", "parameters": {"dataset_definition": {"name": "orders.csv"}}},
        {"node_id": "customers", "type": "SOURCE", "operator": "csv_source_0.1", "parameters": {"dataset_definition": {"name": "customers.csv"}}},
    ]
}


@query("""
    with o as (select order_id, customer_id, purchase_amount, cast(is_reordered as bigint) as is_reordered, age
               from {order_facts} join (select customer_id as k, age from {customers}) c on customer_id = k),
    b as (select min(purchase_amount) as lo, max(purchase_amount) as hi from o)
    select order_id, customer_id, round((purchase_amount - lo) / (hi - lo), 2) as purchase_amount, is_reordered, age from o, b""")
def flow_document(spark: SparkSession, d: str) -> DataFrame:
    """Orders as text, typed, flagged, joined and scaled as a document says."""
    names = ["order_id", "customer_id", "purchase_amount", "is_reordered"]
    orders = frame(spark, d, "order_facts").select(*[F.col(c).cast("string").alias(c) for c in names])
    customers = frame(spark, d, "customers").select("customer_id", "age")
    return run_document(json.dumps(ORDERS_FLOW), {"orders.csv": orders, "customers.csv": customers})


@query("""
    select timestamp '1997-01-01 00:00:00' as written_on, 'o_totalprice' as name, cast(count(*) as double) as size, round(avg(o_totalprice), 2) as mean,
           null::double as largest, null::varchar as note, '1' as flag from orders where o_orderdate < timestamp '1997-01-01 00:00:00'
    union all
    select timestamp '1999-01-01 00:00:00', 'o_totalprice', count(*), null, max(o_totalprice), 'no mean', '"low"' from orders where o_orderdate < timestamp '1999-01-01 00:00:00'""")
def reports_variant(spark: SparkSession, d: str) -> DataFrame:
    """Two runs with different statistics, one of which is a number in one and text in the other."""
    path, orders = scratch_path(spark, "variant"), frame(spark, d, "orders")
    for year, more in ((1997, {"mean": F.round(F.avg("o_totalprice"), 2), "flag": F.lit(1)}), (1999, {"largest": F.max("o_totalprice"), "note": F.lit("no mean"), "flag": F.lit("low")})):
        known = orders.where(F.col("o_orderdate") < F.lit(f"{year}-01-01").cast("timestamp_ntz"))
        made = known.agg(F.count(F.lit(1)).alias("size"), *[v.alias(k) for k, v in more.items()])
        write_report(made.withColumn("name", F.lit("o_totalprice")), path, "orders", datetime(year, 1, 1))
    found = read_reports_variant(spark, path, "orders")
    return found.select("written_on", "name", "size", "mean", "largest", "note", F.to_json("flag").alias("flag"))


@query("""
    with o as (select o_orderkey, row_number() over (order by o_orderkey) as n from orders)
    select concat('order/', o_orderkey) as node, cast(n - 1 as int) as depth from o where n between 2 and 1001""")
def lineage_deep(spark: SparkSession, d: str) -> DataFrame:
    """A chain of a thousand edges: each order leads to the next."""
    orders = frame(spark, d, "orders").select("o_orderkey").orderBy("o_orderkey").limit(1001)
    numbered = row_positions(orders, [F.col("o_orderkey").asc()], "n").select(F.concat(F.lit("order/"), "o_orderkey").alias("node"), "n")
    later = numbered.select(F.col("node").alias("dst"), (F.col("n") - 1).alias("n"))
    chain = durable(numbered.join(later, "n").select(F.col("node").alias("src"), F.lit("training").alias("src_kind"), "dst", F.lit("training").alias("dst_kind")), "chain")
    first = numbered.where("n = 0").first()["node"]
    return reach(chain, first, "down").select("node", "depth")
