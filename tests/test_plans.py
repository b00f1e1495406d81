"""What reaches the scan, and how often rows are shuffled."""

import re

import pytest
from helpers import at, history

from tidemark.operators import ingest as I
from tidemark.operators.dataset import star_join
from tidemark.operators.latest import latest
from tidemark.operators.pit import pit_join
from tidemark.operators.select import get_record


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    df, fg = history(spark, [(i % 7, i, float(i), i, i, False) for i in range(50)])
    df = df.withColumn("unused", df.x)
    path = str(tmp_path_factory.mktemp("plans") / "h")
    df.write.parquet(path)
    return spark.read.parquet(path), fg


def test_record_lookup_is_pushed_below_the_ranking(spark, stored, tmp_path):
    df, fg = stored
    I.write_online(df, fg, str(tmp_path / "on"), 0, "job")
    found = get_record(I.read_online(spark, str(tmp_path / "on"), fg), fg, 3)
    assert re.search(r"PushedFilters: \[[^]]*EqualTo\(id,3\)", plan(found))


def test_as_of_bound_reaches_the_scan(stored):
    df, fg = stored
    assert re.search(r"PushedFilters: \[[^]]*LessThanOrEqual\(event_time,", plan(latest(df, fg, as_of=at(9))))
    assert re.search(r"PushedFilters: \[[^]]*LessThanOrEqual\(event_time,", plan(latest(df, fg, as_of="2024-01-01T09:00:00Z")))


def test_columns_not_asked_for_are_not_read(spark, stored):
    df, fg = stored
    assert "unused" not in plan(latest(df, fg, features=["x"]))
    spine = spark.createDataFrame([(at(5), 1)], "ts timestamp, id long")
    assert "unused" not in plan(pit_join(spine, "ts", fg, df, ["x"]))


def test_no_plan_pairs_rows(spark, stored):
    df, fg = stored
    spine = spark.createDataFrame([(at(5), 1)], "ts timestamp, id long")
    for made in (pit_join(spine, "ts", fg, df, ["x"]), latest(df, fg), star_join(spine, [(df, "id", "id")])):
        assert "NestedLoopJoin" not in plan(made) and "CartesianProduct" not in plan(made)
    assert plan(pit_join(spine, "ts", fg, df, ["x"])).count("Exchange hashpartitioning") == 1
