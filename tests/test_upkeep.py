"""State of streams, incremental runs, bucketed and clustered layouts, and compaction."""

import random
import re
from datetime import timedelta

import pyarrow as pa
import pytest
from helpers import DAY0, at, history, rows
from pyspark.sql import functions as F

from tidemark.model import FeatureGroup
from tidemark.operators import compact as B
from tidemark.operators import ingest as I
from tidemark.operators import materialize as M
from tidemark.operators.dataset import stored_get
from tidemark.operators import profile_state as P
from tidemark.operators.latest import latest
from tidemark.operators.monitor import profile, profile_correlation, profile_numeric
from tidemark.operators.pit import pit_join
from tidemark.session import file_system
from tidemark.skew import Skew
from tidemark.sources import layout as L
from tidemark.sources.files import write_offline
from tidemark.streaming.ingest import file_stream, ingest_stream, read_ingested
from tidemark.streaming import state as stream_state
from tidemark.streaming.state import ROCKSDB, upsert_stream


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(df):
    """Rows that the scan of a plan without a shuffle handed on."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


# Stateful streams

SCHEMA = "id long, event_time timestamp, x double"


def put(spark, folder, data):
    """One CSV file of (id, event hour, x)."""
    frame = spark.createDataFrame([(i, None if e is None else at(e), x) for i, e, x in data], SCHEMA)
    frame.coalesce(1).write.mode("append").option("header", True).csv(folder)


def drain(spark, root, **options):
    fg = FeatureGroup.from_frame("g", spark.createDataFrame([], SCHEMA), "id", "event_time")
    upsert_stream(file_stream(spark, f"{root}/in", SCHEMA), fg, f"{root}/check", f"{root}/on", written=F.lit(DAY0), **options)
    return rows(I.read_online(spark, f"{root}/on", fg, ["id", "x"]))


def test_state_keeps_the_newest_in_any_order(spark, tmp_path):
    root = str(tmp_path)
    put(spark, f"{root}/in", [(1, 5, 1.0), (2, 1, 2.0), (None, 1, 0.0), (3, None, 0.0)])
    assert drain(spark, root) == [(1, 1.0), (2, 2.0)]
    put(spark, f"{root}/in", [(1, 4, 9.0), (2, 3, 3.0), (2, 3, 4.0), (2, 2, 9.0), (4, 0, None)] + [(5, h, float(h)) for h in range(300)])
    found = [(1, 1.0), (2, 4.0), (4, None), (5, 299.0)]
    assert drain(spark, root) == found
    folders = len(I.list_folders(spark, f"{root}/on"))
    assert drain(spark, root) == found and len(I.list_folders(spark, f"{root}/on")) == folders  # started again: nothing new
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != ROCKSDB["spark.sql.streaming.stateStore.providerClass"]


def test_tasks_drop_rows_the_state_would_not_keep(spark, tmp_path):
    root = str(tmp_path)
    put(spark, f"{root}/in", [(i % 3, float(h), float(h)) for h in range(200) for i in range(3)] + [(1, 199.0, -1.0), (9, 0.0, 9.0)])

    assert drain(spark, root) == [(0, 199.0), (1, 199.0), (2, 199.0), (9, 9.0)]
    parts = pa.table({"id": [1, 2, 1, 2, 1], "t": pa.array([1, 5, 3, 5, 2], pa.timestamp("us")), "x": [0, 1, 2, 3, 4]}).to_batches(max_chunksize=2)
    kept = [r for most in (2, 3, 100) for b in [stream_state.newest_of_task(iter(parts), "id", "t", most)] for r in [pa.Table.from_batches(list(b), parts[0].schema)["x"].to_pylist()]]
    assert all({1, 2, 3} <= set(k) for k in kept) and kept[-1] == [1, 2, 3]


def test_state_expires_by_event_time_and_comes_back(spark, tmp_path):
    root, options = str(tmp_path), {"ttl": timedelta(hours=5), "delay": "0 seconds"}
    put(spark, f"{root}/in", [(1, 0, 1.0), (2, 4, 2.0)])
    assert drain(spark, root, **options) == [(1, 1.0), (2, 2.0)]
    put(spark, f"{root}/in", [(3, 6, 3.0)])  # hour 6: record 1 ended at 5
    assert drain(spark, root, **options) == [(2, 2.0), (3, 3.0)]
    put(spark, f"{root}/in", [(1, 7, 7.0), (3, 10, 4.0)])  # record 2 ended at 9, record 3 goes on
    assert drain(spark, root, **options) == [(1, 7.0), (3, 4.0)]


def test_replay_after_stream_compaction(spark, tmp_path):
    root = str(tmp_path)
    fg = FeatureGroup.from_frame("g", spark.createDataFrame([], SCHEMA), "id", "event_time")
    for n in range(5):
        put(spark, f"{root}/in", [(i, n * 24 + i % 7, float(n)) for i in range(20)])

    def run():
        ingest_stream(file_stream(spark, f"{root}/in", SCHEMA, files_per_batch=1), fg, f"{root}/check", offline_path=f"{root}/off", written=F.lit(DAY0))

    def lose_last_commit():
        fs, commits = file_system(spark, f"{root}/check/commits")
        last = max((s.getPath() for s in fs.listStatus(commits) if s.getPath().getName().isdigit()), key=lambda p: int(p.getName()))
        fs.delete(last, False)

    run()
    wanted = rows(read_ingested(spark, f"{root}/off", ["id", "event_time", "x"]))
    for _ in range(3):
        I.compact_stream(spark, f"{root}/off", ["year", "month", "day"])
        lose_last_commit()
        run()
        assert rows(read_ingested(spark, f"{root}/off", ["id", "event_time", "x"])) == wanted
    assert len(wanted) == 100 and len(I.list_folders(spark, f"{root}/off")) == 2  # merged, and the newest batch


def test_stream_batches_of_any_sizes_are_merged(spark, tmp_path):
    path = str(tmp_path / "off")
    noise = spark.range(200_000).select("id", F.rand(1).alias("x"), F.lit(1).alias("day"))  # above the first size class
    for n, part in enumerate((noise, noise.limit(1), noise.limit(2))):
        part.coalesce(1).write.partitionBy("day").parquet(f"{path}/batch=w.{n}")
    I.compact_stream(spark, path, ["day"])
    folders = sorted(f.rsplit("/", 1)[1].split(".")[0] for f in I.list_folders(spark, path))
    assert folders == ["batch=merged", "batch=w"]  # the newest batch stays
    assert read_ingested(spark, path).count() == 200_003
    I.compact_stream(spark, path, ["day"])  # a merged folder waits for others of its size
    assert len(I.list_folders(spark, path)) == 2


def test_size_tiers():
    sizes = {f"d{i}": 10 for i in range(3)}
    assert I.size_tiers(sizes, 4, 100) == []
    assert I.size_tiers({**sizes, "e": 99, "big": 100, "bigger": 401}, 4, 100) == [["d0", "d1", "d2", "e"]]
    assert I.size_tiers({"a": 100, "b": 199, "c": 200}, 2, 100) == [["a", "b"]]


def test_tiered_merges_write_each_row_a_few_times(spark, tmp_path, monkeypatch):
    path, written = str(tmp_path / "on"), []
    df, fg = history(spark, [(i, i, float(i), i, i, False) for i in range(64 * 20)])
    plain = I.write_online

    def counting(frame, fg, path, batch, writer):
        written.append(frame.count())
        plain(frame.coalesce(1), fg, path, batch, writer)

    monkeypatch.setattr(I, "write_online", counting)
    local = df.toPandas()
    for n in range(64):
        part = spark.createDataFrame(local[n * 20 : n * 20 + 20], df.schema).coalesce(1)
        I.write_online(part, fg, path, n, "job")
        if n % 4 == 3:
            I.merge_tiers(spark, path, fg, fanout=4, least=4096)
    assert rows(I.read_online(spark, path, fg)) == rows(latest(df, fg).select(*fg.names))
    # 1280 rows, in classes 4, 16 and 64: written once and merged at most three times
    assert sum(written) <= 4 * 1280 and len(I.list_folders(spark, path)) <= 12


# Incremental materialisation


def test_incremental_runs_equal_one_full_run(spark, tmp_path):
    path, off = str(tmp_path / "on"), str(tmp_path / "off")
    df, fg = history(spark, [(i % 9, (i * 7) % 50, float(i), i, i, i % 11 == 5) for i in range(60)])
    for n in range(3):
        write_offline(df.where((F.col("x") >= 20 * n) & (F.col("x") < 20 * n + 20)), fg, off, stamped=True, grain="day")
        assert M.materialize_since(spark, spark.read.parquet(off), fg, path) >= 20
        assert M.materialize_since(spark, spark.read.parquet(off), fg, path) == 0
    assert M.last_mark(spark, path).run == 2
    assert rows(I.read_online(spark, path, fg)) == rows(latest(df, fg).select(*fg.names))
    marked = M.written_since(spark.read.parquet(off), M.last_mark(spark, path))
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(write_time,", plan(marked)) and marked.count() == 1


def test_rows_of_the_marked_time_and_late_ones(spark, tmp_path):
    path = str(tmp_path / "on")
    first, fg = history(spark, [(1, 1, 1.0, 10, 1, False)])
    more, _ = history(spark, [(2, 1, 2.0, 10, 1, False)])
    late, _ = history(spark, [(3, 1, 3.0, 8, 1, False)])
    assert M.materialize_since(spark, first, fg, path) == 1
    assert M.materialize_since(spark, first.union(more), fg, path) == 2  # of the very same write time
    everything = first.union(more).union(late)
    assert M.materialize_since(spark, everything, fg, path) == 0
    assert M.materialize_since(spark, everything, fg, path, lag=timedelta(hours=3)) == 3
    assert M.materialize_since(spark, everything, fg, path, lag=timedelta(hours=3)) == 0
    assert [r[0] for r in rows(I.read_online(spark, path, fg, ["id"]))] == [1, 2, 3]


def test_a_run_broken_off_is_repeated(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "on")
    df, fg = history(spark, [(1, 1, 1.0, 1, 1, False), (2, 1, 2.0, 2, 2, False)])
    plain = M.write_online

    def breaking(*given):
        plain(*given)
        raise RuntimeError("lost")

    monkeypatch.setattr(M, "write_online", breaking)
    with pytest.raises(RuntimeError):
        M.materialize_since(spark, df, fg, path)
    monkeypatch.undo()
    assert M.last_mark(spark, path) is None and M.materialize_since(spark, df, fg, path) == 2
    assert len([f for f in I.list_folders(spark, path) if "delta=" in f]) == 1
    untimed = df.withColumn("write_time", F.lit(None).cast("timestamp"))
    with pytest.raises(ValueError, match="write_time"):
        M.materialize_since(spark, untimed, fg, str(tmp_path / "other"))
    assert M.materialize_since(spark, df.limit(0), fg, str(tmp_path / "none")) == 0


# Layouts


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    rng = random.Random(4)
    data = [(rng.choice([None, *range(8)]), rng.choice([None, *range(30)]), float(i), rng.randrange(3), 0, rng.random() < 0.1) for i in range(400)]
    df, fg = history(spark, data)
    L.write_bucketed(df, fg, "bucketed_history", str(tmp_path_factory.mktemp("bucketed") / "t"), 6)
    spine = spark.createDataFrame([(n, rng.choice([None, *range(10)]), None if n % 17 == 0 else at(rng.randrange(32))) for n in range(200)], "n long, id long, ts timestamp")
    return df, fg, spine


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("skew", [None, Skew(target_rows=60, fraction=0.01, min_bytes=0)])
def test_bucketed_lookup_equals_the_sweep(spark, bucketed, strict, skew):
    df, fg, spine = bucketed
    stored = spark.table("bucketed_history")
    found = pit_join(spine, "ts", fg, stored, ["x"], strategy="bucketed", strict=strict, skew=skew)
    assert rows(found) == rows(pit_join(spine, "ts", fg, df, ["x"], strict=strict, skew=None))


def test_only_the_spine_of_a_bucketed_lookup_moves(spark, bucketed):
    df, fg, spine = bucketed
    text = plan(pit_join(spine, "ts", fg, spark.table("bucketed_history"), ["x"], strategy="bucketed"))
    assert text.count("Exchange hashpartitioning") == 1 and "SelectedBucketsCount: 6 out of 6" in text
    with pytest.raises(ValueError, match="bucketed"):
        pit_join(spine, "ts", fg, df, ["x"], strategy="bucketed")
    assert L.bucket_count(df) is None and L.bucket_count(spark.table("bucketed_history")) == 6


def test_lookups_skip_row_groups(spark, tmp_path):
    path = str(tmp_path / "h")
    df, fg = history(spark, [])
    ids = spark.range(0, 40_000, 1, 4).select((F.col("id") * 2).alias("id"))  # even ones only
    wide = ids.select("id", F.lit(DAY0).alias("event_time"), F.rand(1).alias("x"), F.lit(DAY0).alias("write_time"), F.lit(DAY0).alias("api_invocation_time"), F.lit(False).alias("is_deleted"))
    for _ in range(2):
        L.write_clustered(wide, fg, path, files=4, row_group=64 << 10, distinct=5_000)
    stored = spark.read.parquet(path)
    assert scanned(L.of_ids(stored, "id", [10, 50_000])) < 40_000  # of 80,000: other ranges are skipped
    assert scanned(L.of_ids(stored, "id", [11, 50_001])) == 0  # in range, but in no Bloom filter
    assert scanned(L.of_ids(stored, "id", list(range(1, 1001, 2)))) == 0  # 500 ids, each asked for
    assert rows(stored_get(stored, fg, [10, None, 12, 13, 10]).select("id")) == [(10,), (12,)]
    many = spark.range(5000).select(F.col("id").alias("other"))
    assert stored_get(stored, fg, many).count() == 2500 and stored_get(stored, fg, []).count() == 0


def test_erasure_asks_the_scan_for_few_ids(spark, tmp_path):
    df, fg = history(spark, [(i, i, float(i), i, i, False) for i in range(30)])
    L.write_clustered(df, fg, str(tmp_path / "h"), files=3)
    found = L.of_ids(spark.read.parquet(str(tmp_path / "h")), "id", spark.createDataFrame([(3,), (None,), (25,)], "z long"))
    assert re.search(r"PushedFilters: .*In\(id, \[(3,25|25,3)\]\)", plan(found)) and found.count() == 2


# Bin packing


def test_first_fit():
    assert B.first_fit([], 10) == []
    assert B.first_fit([3, 9, 4, 2, 6], 10) == [2, 0, 1, 2, 1]
    rng = random.Random(1)
    sizes = [rng.randint(1, 60) for _ in range(200)]
    place = B.first_fit(sizes, 100)
    filled = [sum(s for s, p in zip(sizes, place) if p == b) for b in range(max(place) + 1)]
    assert max(filled) <= 100 and sum(f <= 50 for f in filled) <= 1


def stored(spark, path, counts):
    """A table with a null, an empty and an odd partition value, each in files of the given row counts."""
    n = 0
    for count in counts:
        for kind in ("a b", "ü=/%", "", None):
            frame = spark.range(n, n + count, 1, 1).select("id", F.lit(kind).cast("string").alias("kind"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
            frame.write.mode("append").partitionBy("kind").parquet(path)
            n += count
    return rows(spark.read.parquet(path))


def test_only_small_files_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    wanted = stored(spark, path, [3000, 20, 30, 40])
    before = {r["file"]: r["bytes"] for r in B.stored_files(spark, path).collect()}
    large = {f for f, size in before.items() if size > 100_000}
    fs, _ = file_system(spark, path)
    times = lambda: {f: fs.getFileStatus(spark._jvm.org.apache.hadoop.fs.Path(f)).getModificationTime() for f in large}
    first = times()
    assert len(large) == 4 and B.compact_binpack(spark, path, target_bytes=100_000) > 0
    after = {r["file"] for r in B.stored_files(spark, path).collect()}
    assert large <= after and times() == first and len(after) < len(before)
    assert rows(spark.read.parquet(path)) == wanted
    assert B.compact_binpack(spark, path, target_bytes=100_000) == 0
    assert not [f for f in I.list_folders(spark, path) if "_binpack" in f]


@pytest.mark.parametrize("moment", ["written", "planned", "moved"])
def test_bin_packing_broken_off(spark, tmp_path, monkeypatch, moment):
    path = str(tmp_path / "t")
    wanted = stored(spark, path, [20, 30])
    plain, calls = B._finish, []

    def breaking(*given):
        calls.append(1)
        if len(calls) == 2:  # the first one clears the ground
            if moment == "moved":
                monkeypatch.setattr(B, "_replace", lost_midway)
                plain(*given)
            raise RuntimeError("lost")
        plain(*given)

    whole = B._replace

    def lost_midway(spark, made, folder, old):
        whole(spark, made, folder, old[:1])
        raise RuntimeError("lost")

    if moment == "written":
        monkeypatch.setattr(B, "_rewrite", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    else:
        monkeypatch.setattr(B, "_finish", breaking)
    with pytest.raises(RuntimeError):
        B.compact_binpack(spark, path, target_bytes=100_000)
    monkeypatch.undo()
    B.compact_binpack(spark, path, target_bytes=100_000)
    assert rows(spark.read.parquet(path)) == wanted
    assert B.compact_binpack(spark, path, target_bytes=100_000) == 0


def test_bins_over_several_jobs(spark, tmp_path):
    path = str(tmp_path / "t")
    wanted = stored(spark, path, [5, 6, 7])
    assert B.compact_binpack(spark, path, target_bytes=100_000, at_once=2) > 0
    assert rows(spark.read.parquet(path)) == wanted and len({r["folder"] for r in B.stored_files(spark, path).collect()}) == B.stored_files(spark, path).count()


# Stored profiles


def test_profiles_merge_from_states(spark, tmp_path):
    table, states = str(tmp_path / "t"), str(tmp_path / "s")
    rng = random.Random(2)
    data = [(n, ["a b", "ü=/%", None][n % 3], rng.choice([None, float("nan"), float("inf"), 1e9 + rng.random()]) if n % 4 == 0 else 1e9 + rng.random(), n % 7 if n % 5 else None) for n in range(900)]
    df = spark.createDataFrame(data, "id long, kind string, x double, k int")
    df.where("kind is not null").coalesce(2).write.partitionBy("kind").parquet(table)
    names = ["x", "k"]
    assert P.update_states(spark, table, states, names) == 2 and P.update_states(spark, table, states, names) == 0
    df.where("kind is null").coalesce(1).write.mode("append").partitionBy("kind").parquet(table)
    assert P.update_states(spark, table, states, names) == 1

    def same():
        stored = spark.read.parquet(table)
        held = P.read_states(spark, table, states, names)
        for a, b in zip(rows(P.merged_profile(held)), rows(profile_numeric(stored, names)), strict=True):
            assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-6)
        assert rows(P.merged_correlation(held))[0][2] == pytest.approx(rows(profile_correlation(stored, names))[0][2], abs=1e-6)  # values near 1e9 leave few digits

    same()
    spark.createDataFrame(data[:30], df.schema).where("kind = 'a b'").write.mode("append").partitionBy("kind").parquet(table)
    assert P.update_states(spark, table, states, names) == 1  # only the partition that grew
    same()
    assert P.update_states(spark, table, states, ["x"]) == 3  # other columns are other states
    I.delete_path(spark, [f for f in I.list_folders(spark, table) if f.endswith("kind=a b")][0])
    same()


def test_states_are_made_by_one_scan_and_quantiles_hold(spark, tmp_path):
    table, states = str(tmp_path / "t"), str(tmp_path / "s")
    spark.range(0, 20_000, 1, 4).select(F.col("id").cast("double").alias("x"), (F.col("id") % 5).alias("part")).write.partitionBy("part").parquet(table)
    assert plan(P.partial_states(spark.read.parquet(table), ["x"])).count("FileScan") == 1
    P.update_states(spark, table, states, ["x"])
    for _, share, value in rows(P.merged_quantiles(P.read_states(spark, table, states, ["x"]), [0.01, 0.25, 0.5, 0.99])):
        assert abs(value / 20_000 - share) < 0.02
    empty = P.read_states(spark, table, str(tmp_path / "none"), ["x"])
    assert rows(P.merged_profile(empty)) == rows(P.merged_quantiles(empty, [0.5])) == []


def test_a_profile_takes_two_scans(spark, tmp_path):
    spark.range(100).select(F.col("id").cast("double").alias("x")).write.parquet(str(tmp_path / "t"))
    df = profile(spark.read.parquet(str(tmp_path / "t")), ["x"])
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert final.count("FileScan") == 1  # the scan for counts and moments came before
