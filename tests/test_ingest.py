from datetime import timedelta

import pytest
from helpers import at, history, rows
from pyspark.sql import functions as F

from tidemark.model import FeatureGroup
from tidemark.operators import ingest as I
from tidemark.operators.latest import latest
from tidemark.sources import files as S
from tidemark.sources.versions import hard_delete
from tidemark.streaming.ingest import file_stream, ingest_stream, read_ingested


def test_rejected_rows_have_a_reason_and_none_is_lost(spark):
    df = spark.createDataFrame(
        [("1", "2024-01-01T00:00:00Z", "1.5"), (None, "2024-01-01T00:00:00Z", "1"), ("2", "never", "1"),
         ("3", None, "1"), ("4", "2024-01-01T00:00:00Z", "x"), ("y", "never", "x")],
        "id string, event_time string, v string",
    )
    fg = FeatureGroup.declared("g", [("id", "long"), ("event_time", "string"), ("v", "float")], "id", "event_time")
    valid, failed = I.split_valid(df, fg)
    assert valid.count() + failed.count() == df.count()
    assert rows(valid) == [(1, at(0), 1.5)]
    assert [r[0] for r in rows(failed, "failure_reason")] == [
        "bad event_time", "bad event_time; cannot cast id; cannot cast v", "cannot cast v", "null event_time", "null id"
    ]
    _, missing = I.split_valid(df.drop("v"), fg)
    assert missing.count() == 6 and "missing column v" in missing.first()["failure_reason"]


def test_upsert_keeps_the_newer_event(spark):
    now, fg = history(spark, [(1, 5, 1.0, 1, 1, False), (2, 5, 1.0, 1, 1, False), (3, 5, 1.0, 1, 1, False)])
    new, _ = history(spark, [(1, 4, 9.0, 2, 2, False), (2, 5, 9.0, 2, 2, False), (3, 6, 8.0, 2, 2, False),
                             (3, 7, 9.0, 2, 2, False), (4, 1, 9.0, 2, 2, False)])
    assert rows(I.online_upsert(now, new, fg), "id", "x") == [(1, 1.0), (2, 9.0), (3, 9.0), (4, 9.0)]


def test_patch_changes_only_given_values(spark):
    now, fg = history(spark, [(1, 5, 1.0, 1, 1, False), (2, 5, 1.0, 1, 1, False)])
    change = spark.createDataFrame([(1, at(9), None), (2, at(9), 99.99)], "id long, event_time timestamp, x double")
    assert rows(I.patch(now, change, fg), "id", "event_time", "x") == [(1, at(9), 1.0), (2, at(9), 99.99)]


def test_soft_delete_only_when_newer(spark):
    df, fg = history(spark, [(1, 5, 1.0, 1, 1, False), (2, 9, 1.0, 1, 1, False)])
    ids = spark.createDataFrame([(1,), (2,), (1,)], "id long")
    after = I.soft_delete(df, fg, ids, at(7))
    assert after.count() == 3
    marker = after.where("is_deleted").first()
    assert (marker.id, marker.event_time, marker.x) == (1, at(7), None)
    assert rows(latest(after, fg), "id") == [(2,)]


def test_hard_delete_removes_rows_written_after_the_marker(spark):
    df, fg = history(spark, [(1, 1, 1.0, 1, 1, False), (1, 2, None, 2, 2, True), (1, 3, 3.0, 3, 3, False), (2, 1, 1.0, 1, 1, None)])
    assert rows(hard_delete(df, fg), "id") == [(2,)]
    online, marked = I.hard_delete_online(df.where("id = 2"), df, fg, spark.createDataFrame([(2,)], "id long"), at(9))
    assert online.count() == 0 and rows(marked.where("is_deleted"), "id") == [(1,), (2,)]


def test_ttl(spark):
    df, fg = history(spark, [(1, 1, 1.0, 1, 1, False), (2, 5, 2.0, 1, 1, False), (3, 4, 3.0, 1, 1, False)])
    kept, marked = I.expire_ttl(df.select("id", "event_time", "x"), df, fg, timedelta(hours=6), at(10))
    assert rows(kept, "id") == [(2,)]
    assert rows(marked.where("is_deleted"), "id", "event_time") == [(1, at(10)), (3, at(10))]


def test_hard_delete_in_place_touches_only_affected_partitions(spark, tmp_path):
    path = str(tmp_path / "h")
    df, fg = history(spark, [(1, 1, 1.0, 1, 1, False), (1, 25, None, 2, 2, True), (2, 1, 2.0, 1, 1, False),
                             (3, 80, 3.0, 1, 1, False)])
    S.write_offline(df, fg, path, stamped=True, grain="day")
    before = {r.partition: r.total_size for r in S.partition_stats(spark, path).collect()}
    assert I.hard_delete_offline(spark, path, fg, ["year", "month", "day"]) == 2
    assert rows(spark.read.parquet(path), "id", "x") == [(2, 2.0), (3, 3.0)]
    after = {r.partition: r.total_size for r in S.partition_stats(spark, path).collect()}
    assert set(before) - set(after) == {"year=2024/month=1/day=2"}
    assert after["year=2024/month=1/day=4"] == before["year=2024/month=1/day=4"]
    assert I.hard_delete_offline(spark, path, fg, ["year", "month", "day"]) == 0


def test_routing(spark, tmp_path):
    df, fg = history(spark, [(1, 1, 1.0, 1, 1, False), (1, 2, 2.0, 1, 1, False), (None, 1, 1.0, 1, 1, False)])
    off, on = str(tmp_path / "off"), str(tmp_path / "on")
    failed = I.ingest(df.select(*fg.names), fg, ["offline", "online"], offline_path=off, online_path=on, batch=1, writer="job")
    assert failed.count() == 1
    assert S.read_offline(spark, off).count() == 2
    assert rows(I.read_online(spark, on, fg), "id", "x") == [(1, 2.0)]
    I.ingest(df.select(*fg.names), fg, ["online"], online_path=on, batch=1, writer="job")  # the same batch again
    late, _ = history(spark, [(1, 0, 9.0, 9, 9, False), (5, 0, 5.0, 9, 9, False)])
    I.ingest(late.select(*fg.names), fg, ["online"], online_path=on, batch=2, writer="job")
    assert rows(I.read_online(spark, on, fg), "id", "x") == [(1, 2.0), (5, 5.0)]
    I.compact_online(spark, on, fg)
    assert len(list((tmp_path / "on").glob("delta=*"))) == 1
    assert rows(I.read_online(spark, on, fg), "id", "x") == [(1, 2.0), (5, 5.0)]
    I.ingest(late.select(*fg.names), fg, ["online"], online_path=on, batch=2, writer="job")  # again after the merge
    assert rows(I.read_online(spark, on, fg), "id", "x") == [(1, 2.0), (5, 5.0)]
    with pytest.raises(ValueError):
        I.ingest(df, fg, ["nowhere"])


def test_partition_pruning_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "h")
    df, fg = history(spark, [(i, i, float(i), 1, 1, False) for i in range(100)])
    S.write_offline(df, fg, path, stamped=True, grain="hour")
    got = S.read_offline(spark, path, start=at(20), end=at(30), grain="hour")
    assert sorted(r.id for r in got.collect()) == list(range(20, 31))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(" in plan or "PartitionFilters: [isnotnull" in plan


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_dataset_formats(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, at(1.0001))], "id long, t timestamp")
    S.write_dataset(df, str(tmp_path / fmt), fmt)
    assert rows(spark.read.format(fmt).schema(df.schema).load(str(tmp_path / fmt))) == [(1, at(1.0001))]


def test_spread(spark):
    assert S.spread(spark.range(100)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism * 3


def test_month_folders_and_empty_prefix(spark, tmp_path):
    df = spark.createDataFrame([(1, "2020-01-31 23:59:59"), (2, "2020-02-01 00:00:00")], "id long, t string")
    S.write_by_month(df.withColumn("t", F.col("t").cast("timestamp")), "t", str(tmp_path / "m"))
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "m")), "id", "year_month") == [("1", "2020-1"), ("2", "2020-2")]
    empty = S.read_prefix(spark, str(tmp_path / "none"), "a long, b string")
    assert empty.count() == 0 and empty.columns == ["a", "b"]


def test_stream_equals_batch_and_repeats_change_nothing(spark, tmp_path):
    schema = "id long, event_time string, x double"
    fg = FeatureGroup.declared("g", [("id", "long"), ("event_time", "string"), ("x", "float")], "id", "event_time")
    src, off, on, bad = (str(tmp_path / n) for n in ("src", "off", "on", "bad"))

    def arrive(name, lines):
        (tmp_path / "src").mkdir(exist_ok=True)
        (tmp_path / "src" / name).write_text("id,event_time,x\n" + "\n".join(lines) + "\n")

    def drain():
        ingest_stream(
            file_stream(spark, src, schema, files_per_batch=1), fg, str(tmp_path / "check"),
            offline_path=off, online_path=on, failed_path=bad, transform=lambda d: d.withColumn("x", F.col("x") * 2),
        )

    arrive("b.csv", ["1,2024-01-02T00:00:00Z,2.0", "2,2024-01-01T00:00:00Z,1.0", "3,broken,1.0"])
    drain()
    arrive("a.csv", ["1,2024-01-01T00:00:00Z,9.0", "2,2024-01-03T00:00:00Z,3.0"])  # late for id 1
    drain()
    drain()  # nothing new
    assert rows(read_ingested(spark, off, ["id", "x"])) == [(1, 18.0), (1, 4.0), (2, 2.0), (2, 6.0)]
    assert rows(I.read_online(spark, on, fg, ["id", "x"])) == [(1, 4.0), (2, 6.0)]
    assert spark.read.json(bad).count() == 1


def test_compaction_in_place_rewrites_crowded_partitions_once(spark, tmp_path):
    path = str(tmp_path / "h")
    df, fg = history(spark, [(1, 1, 1.0, 1, 1, False), (2, 25, 2.0, 1, 1, False), (3, 2, 3.0, 1, 1, False)])
    for part in (df.where("id < 3"), df.where("id = 3")):
        S.write_offline(part, fg, path, stamped=True, grain="day")
    assert I.compact_offline(spark, path, ["year", "month", "day"]) == 1
    assert I.compact_offline(spark, path, ["year", "month", "day"]) == 0
    assert {r.file_count for r in S.partition_stats(spark, path).collect()} == {1}
    assert rows(spark.read.parquet(path), "id", "x") == [(1, 1.0), (2, 2.0), (3, 3.0)]


def test_compacted_files_are_no_larger_than_their_parts(spark, tmp_path):
    path = str(tmp_path / "h")
    hour = F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.xxhash64("id"), F.lit(300)) * 3600)
    df = spark.range(60_000).select("id", hour.alias("event_time"), F.round(F.rand(1) * 500_000, 2).alias("x"))
    df = df.withColumns({c: F.col("event_time") + F.make_dt_interval(secs=F.col("id")) for c in ("write_time", "api_invocation_time")})
    df = df.withColumn("is_deleted", F.lit(False))
    fg = FeatureGroup.from_frame("g", df, "id", "event_time")
    for n in range(3):
        S.write_offline(df.where(F.col("id") % 3 == n), fg, path, stamped=True, grain="year")
    before = S.partition_stats(spark, path).first()
    assert before.file_count == 3 and I.compact_offline(spark, path, ["year"]) == 1
    after = S.partition_stats(spark, path).first()
    assert after.file_count == 1 and after.total_size <= before.total_size
    assert spark.read.parquet(path).drop("year").exceptAll(df).isEmpty() and spark.read.parquet(path).count() == 60_000


def test_feature_added_later_is_null_in_older_rows(spark, tmp_path):
    df, fg = history(spark, [(1, 1, 1.0, 1, 1, False)])
    off, on = str(tmp_path / "off"), str(tmp_path / "on")
    I.ingest(df.select(*fg.names), fg, ["offline", "online"], offline_path=off, online_path=on, batch=0, writer="job")
    grown = fg.add_feature("kids", df.schema["id"].dataType)
    new, _ = history(spark, [(2, 1, 2.0, 1, 1, False)])
    new = new.select(*fg.names).withColumn("kids", new.id)
    I.ingest(new, grown, ["offline", "online"], offline_path=off, online_path=on, batch=1, writer="job")
    assert rows(I.read_online(spark, on, grown, ["id", "kids"])) == [(1, None), (2, 2)]
    assert rows(S.read_offline(spark, off, merge_schema=True), "id", "kids") == [(1, None), (2, 2)]


def test_writers_keep_to_their_own_batches(spark, tmp_path):
    df, fg = history(spark, [(1, 1, 1.0, 1, 1, False), (2, 1, 2.0, 1, 1, False)])
    on = str(tmp_path / "on")
    for writer, part in (("a", df.where("id = 1")), ("b", df.where("id = 2"))):
        I.ingest(part.select(*fg.names), fg, ["online"], online_path=on, batch=0, writer=writer)
    assert rows(I.read_online(spark, on, fg), "id") == [(1,), (2,)]
    for wrong in ({"batch": 0}, {"writer": "a"}, {"batch": 0, "writer": "a/b"}):
        with pytest.raises(ValueError):
            I.ingest(df.select(*fg.names), fg, ["online"], online_path=on, **wrong)
    assert I.erase_online(spark, on, fg, spark.createDataFrame([(1,)], "id long")) == 1
    assert rows(spark.read.schema(I.online_schema(fg)).parquet(on), "id") == [(2,)]


def test_expiry_of_the_stored_table(spark, tmp_path):
    df, fg = history(spark, [(1, 1, 1.0, 1, 1, False), (2, 50, 2.0, 1, 1, False)])
    on = str(tmp_path / "on")
    I.write_online(df, fg, on, 0, "a")
    assert rows(I.expire_online(spark, on, fg, timedelta(hours=10), at(55))) == [(1,)]
    assert rows(I.read_online(spark, on, fg), "id") == [(2,)]


def test_erasure_in_the_null_partition_and_wrong_layouts(spark, tmp_path):
    df, fg = history(spark, [(1, 1, 1.0, 1, 1, False), (1, None, 1.0, 1, 1, False), (1, 5, None, 2, 2, True), (2, None, 2.0, 1, 1, False), (3, None, 2.0, 1, 1, False)])
    path = str(tmp_path / "h")
    for part in (df.where("id <> 3"), df.where("id = 3")):
        S.write_offline(part, fg, path, stamped=True, grain="day")
    before = sorted(p.relative_to(path) for p in (tmp_path / "h").rglob("*"))
    for wrong in (["year"], ["day"], ["year", "month", "day", "hour"]):
        with pytest.raises(ValueError):
            I.hard_delete_offline(spark, path, fg, wrong)
    assert sorted(p.relative_to(path) for p in (tmp_path / "h").rglob("*")) == before
    I.hard_delete_offline(spark, path, fg, ["year", "month", "day"])
    I.compact_offline(spark, path, ["year", "month", "day"])
    assert rows(spark.read.parquet(path), "id") == [(2,), (3,)]
    assert {r.file_count for r in S.partition_stats(spark, path).collect()} == {1}


def test_patch_takes_the_newest_change_and_no_older_one(spark):
    df, fg = history(spark, [(1, 5, 1.0, 1, 1, False), (2, 5, 2.0, 1, 1, False)])
    online = df.select("id", "event_time", "x")
    changes = spark.createDataFrame([(1, at(6), 10.0), (1, at(7), None), (2, at(1), 20.0)], "id long, event_time timestamp, x double")
    assert rows(I.patch(online, changes, fg), "id", "x") == [(1, 1.0), (2, 2.0)]
    assert rows(I.patch(online, changes.drop("event_time").where("x > 10"), fg), "id", "x") == [(1, 1.0), (2, 20.0)]


def test_upsert_compares_text_as_instants(spark):
    shape = "id long, event_time string, x double"
    current = spark.createDataFrame([(1, "2024-01-01T00:00:00.500Z", 1.0), (2, "2024-01-01T01:00:00+02:00", 1.0)], shape)
    incoming = spark.createDataFrame([(1, "2024-01-01T00:00:00Z", 2.0), (2, "2024-01-01T00:30:00Z", 2.0), (3, "2024-01-01T00:00:00Z", 2.0)], shape)
    fg = FeatureGroup.from_frame("g", current, "id", "event_time")
    assert rows(I.online_upsert(current, incoming, fg), "id", "x") == [(1, 1.0), (2, 2.0), (3, 2.0)]


def test_a_record_without_event_time_does_not_expire(spark):
    df, fg = history(spark, [(1, None, 1.0, 1, 1, False), (2, 1, 1.0, 1, 1, False)])
    kept, marked = I.expire_ttl(df, df, fg, timedelta(hours=1), at(50))
    assert rows(kept, "id") == [(1,)] and marked.count() == 3
