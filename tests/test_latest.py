import random

import pytest
from helpers import at, history, rows

from tidemark.model import FeatureGroup
from tidemark.operators import latest as L
from tidemark.operators import select as S
from tidemark.skew import Skew


def test_ties_are_broken_by_api_then_write_then_value(spark):
    df, fg = history(
        spark,
        [
            (1, 5, 1.0, 9, 1, False), (1, 5, 2.0, 8, 2, False),  # later API call wins over later write
            (2, 5, 1.0, 8, 1, False), (2, 5, 2.0, 9, 1, False),  # later write wins
            (3, 5, 1.0, 8, 1, False), (3, 5, 2.0, 8, 1, False),  # full tie: the larger value
        ],
    )
    assert rows(L.latest(df, fg), "id", "x") == [(1, 2.0), (2, 2.0), (3, 2.0)]
    assert rows(L.latest(df, fg, ties="all"), "id", "x") == [(1, 2.0), (2, 2.0), (3, 1.0), (3, 2.0)]


def test_marker_as_newest_row(spark):
    df, fg = history(spark, [(1, 1, 1.0, 1, 1, False), (1, 2, None, 2, 2, True), (2, 1, 3.0, 1, 1, False)])
    assert rows(L.latest(df, fg), "id", "x") == [(2, 3.0)]
    assert rows(L.latest(df, fg, deleted="before"), "id", "x") == [(1, 1.0), (2, 3.0)]
    assert rows(L.materialized(df, fg, "event_time_only"), "id", "x") == [(1, None), (2, 3.0)]
    assert L.materialized(df, fg).columns == ["id", "event_time", "x"]


def test_row_written_after_its_marker_is_back(spark):
    df, fg = history(spark, [(1, 1, None, 1, 1, True), (1, 2, 5.0, 2, 2, False)])
    assert rows(L.latest(df, fg), "id", "x") == [(1, 5.0)]


def test_null_marker_flag_is_dropped(spark):
    df, fg = history(spark, [(1, 1, 1.0, 1, 1, None)])
    assert L.latest(df, fg).count() == 0


def test_as_of_includes_the_instant_and_accepts_text(spark):
    df, fg = history(spark, [(1, 1, 1.0, 1, 1, False), (1, 24, 2.0, 2, 2, False), (1, 25, 3.0, 3, 3, False)])
    assert rows(L.as_of(df, fg, at(24)), "x") == [(2.0,)]
    assert rows(L.as_of(df, fg, "2024-01-02t00:00:00z"), "x") == [(2.0,)]
    assert rows(L.as_of(df, fg, at(0.5)), "x") == []
    assert rows(L.as_of(df, fg, at(24), ids=[2]), "x") == []


def test_feature_list_and_ids(spark):
    df, fg = history(spark, [(1, 1, 1.0, 1, 1, False), (2, 1, 2.0, 1, 1, False)])
    assert L.latest(df, fg, features=["x"]).columns == ["x"]
    assert rows(L.latest(df, fg, ids=[1]), "id") == [(1,)]
    assert L.by_ids(df, "id", []).count() == 0
    assert L.by_ids(df, "id", None).count() == 2
    assert L.by_ids(df, "id", spark.createDataFrame([(2,), (2,), (9,)], "k long")).count() == 1


def test_text_and_epoch_event_times(spark):
    # Text compared as text would put ...00.000Z before ...00Z; as times they are equal.
    text = spark.createDataFrame(
        [(1, "2024-01-01T00:00:00Z", 1.0, False), (1, "2024-01-01T00:00:00.500Z", 2.0, False)],
        "id long, event_time string, x double, is_deleted boolean",
    )
    assert rows(L.latest(text, FeatureGroup.from_frame("g", text, "id", "event_time")), "x") == [(2.0,)]
    epoch = spark.createDataFrame(
        [(1, 1652374550.0, 132, 150, False), (2, 1652374551.0, 168, 258, False), (3, 1652374552.0, 125, 184, False),
         (1, 1652374553.0, 195, 206, False)],
        "record_id long, event_time double, feature_11 long, feature_12 long, is_deleted boolean",
    )
    fg = FeatureGroup.from_frame("g", epoch, "record_id", "event_time")
    assert rows(L.latest(epoch, fg), "record_id", "feature_11", "feature_12") == [(1, 195, 206), (2, 168, 258), (3, 125, 184)]


def test_nine_row_materialisation(spark):
    data = [(i, m, f"2021-03-0{k}T01:0{i}:00Z", False) for i in (1, 2, 3) for k, m in ((1, 0.1), (2, 0.2), (3, 0.3))]
    df = spark.createDataFrame(data, "RecordIdentifier long, Measure double, EventTime string, is_deleted boolean")
    fg = FeatureGroup.from_frame("m", df, "RecordIdentifier", "EventTime")
    for mode in ("strict", "event_time_only"):
        assert rows(L.materialized(df, fg, mode), "RecordIdentifier", "Measure") == [(1, 0.3), (2, 0.3), (3, 0.3)]


@pytest.mark.parametrize("ties", ["first", "all"])
def test_salted_ranking_equals_plain_ranking(spark, monkeypatch, ties):
    rng = random.Random(3)
    df, fg = history(
        spark, [(rng.choice([1, 1, 1, 2, 3]), rng.randrange(12), float(rng.randrange(4)), 1, 1, False) for _ in range(300)]
    )
    plain = rows(L.latest(df, fg, n=7, ties=ties))
    monkeypatch.setattr(L, "GROUP_LIMIT", 2)
    assert rows(L.latest(df, fg, n=7, ties=ties)) == plain


@pytest.mark.parametrize("order", ["full", "event_time"])
@pytest.mark.parametrize("n", [1, 3])
def test_large_ties_kept_by_join(spark, order, n):
    rng = random.Random(4)
    df, fg = history(
        spark,
        [(rng.choice([1, 1, 1, 2, None]), rng.choice([1, 5, 5, None]), float(rng.randrange(3)), rng.randrange(2), 1, False)
         for _ in range(200)],
    )
    every = Skew(target_rows=1, fraction=1e-5, min_bytes=0)
    plain = rows(L.latest(df, fg, ties="all", order=order, n=n, skew=None))
    joined = L.latest(df, fg, ties="all", order=order, n=n, skew=every)
    assert "LeftSemi" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert rows(joined) == plain


def test_ranking_happens_before_the_shuffle(spark):
    df, fg = history(spark, [(1, 1, 1.0, 1, 1, False)])
    plan = L.latest(df, fg)._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("WindowGroupLimit", plan.index("Exchange"))
    assert plan.count("WindowGroupLimit") == 2 and partial > plan.index("Exchange")


def test_wrong_options_raise(spark):
    df, fg = history(spark, [])
    for bad in ({"ties": "some"}, {"deleted": "never"}, {"order": "random"}):
        with pytest.raises(ValueError):
            L.latest(df, fg, **bad)


def test_empty_history(spark):
    df, fg = history(spark, [])
    assert L.latest(df, fg).count() == 0 and L.latest(df, fg).columns == df.columns


def test_overlapping_view_names(spark):
    df, _ = history(spark, [(1, 1, 1.0, 1, 1, False)])
    out = S.query({"orders": df, "orders-old": df.limit(0)}, "select count(*) n from orders where id not in (select id from orders_old)")
    assert rows(out) == [(1,)]


def test_small_operators(spark):
    df, fg = history(spark, [(1, 1, 1.0, 1.0001, 1, False), (2, 3, None, 2, 2, True)])
    assert rows(S.record_count(df)) == [(2,)]
    assert rows(S.minmax_timestamps(df, fg)) == [(at(1.0001), at(2), at(1), at(3))]
    assert rows(S.write_time_cutoff(df)) == [(at(2),)]
    assert S.where_present(df, "x").count() == 1
    assert S.drop_deleted(df).count() == 1
    assert S.lower_names(df.withColumnRenamed("x", "X")).columns == df.columns
    assert S.label_first(df, "x").columns[0] == "x"
    assert S.sanitize_names(df.withColumnRenamed("x", "a b")).columns[2] == "a_b"
    assert rows(S.availability({"g": df}, {"g": 3})) == [("g", 2, 3, False)]
    assert S.bernoulli_sample(df, fg, 100.0, 1).count() == 1
    assert rows(S.get_record(df, fg, 2, ["id"])) == [(2,)]
