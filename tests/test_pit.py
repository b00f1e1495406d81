import random

import pytest
from helpers import at, history, rows

from tidemark.model import FeatureGroup, parse_features
from tidemark.operators.pit import get_features, hot_records, pit_join, pit_recent
from tidemark.skew import Skew

# Every record with more than a handful of rows counts as hot.
HOT = Skew(target_rows=5, fraction=0.01, min_bytes=0)


def brute(spine, data, n=1, strict=False):
    """Expected (row number, values) by comparing every pair."""
    out = []
    for i, (key, ts) in enumerate(spine):
        seen = [
            r for r in data
            if key is not None and ts is not None and r[0] == key and r[1] is not None
            and (r[1] < ts if strict else r[1] <= ts)
        ]
        seen.sort(key=lambda r: (r[1], r[3], r[2] is not None, r[2] or 0, r[5]), reverse=True)
        out.append((i, [None if r[5] else r[2] for r in seen[:n]]))
    return out


def make(spark, seed, hot_share=0.5):
    rng = random.Random(seed)

    def key():
        return 1 if rng.random() < hot_share else rng.choice([2, 3, 4, None])

    data = []
    for _ in range(150):
        dead = rng.random() < 0.15
        hour = rng.choice([3, 3, 3, *range(20)])
        data.append((key(), hour, None if dead else float(rng.randrange(5)), rng.randrange(4), 0, dead))
    spine = [(key(), rng.choice([7, 7, 7, None, *range(20)])) for _ in range(90)]
    df, fg = history(spark, data)
    frame = spark.createDataFrame(
        [(i, k, None if t is None else at(t)) for i, (k, t) in enumerate(spine)], "row int, id long, ts timestamp"
    )
    return frame, spine, df, data, fg


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("strict", [False, True])
def test_all_plans_agree_with_brute_force(spark, seed, strict):
    frame, spine, df, data, fg = make(spark, seed)
    expected = sorted((i, v[0] if v else None) for i, v in brute(spine, data, strict=strict))
    for options in ({"skew": None}, {"skew": HOT}, {"strategy": "join_rank"}):
        got = pit_join(frame, "ts", fg, df, ["x"], strict=strict, **options).select("row", "x").collect()
        assert sorted(tuple(r) for r in got) == expected, options


@pytest.mark.parametrize("skew", [None, HOT])
@pytest.mark.parametrize("n", [1, 2, 4])
def test_recent_rows_agree_with_brute_force(spark, skew, n):
    frame, spine, df, data, fg = make(spark, 5)
    pairs = brute(spine, data, n)
    inner = sorted((i, v) for i, vs in pairs for v in vs if v is not None)
    left = sorted(((i, v) for i, vs in pairs for v in (vs or [None])), key=repr)
    # A live row always has a value here, so null means a marker or no history.
    got = pit_recent(frame, "ts", fg, df, ["x"], n=n, skew=skew, how="inner").select("row", "x").collect()
    assert sorted(tuple(r) for r in got) == inner
    got = pit_recent(frame, "ts", fg, df, ["x"], n=n, skew=skew).select("row", "x").collect()
    assert sorted((tuple(r) for r in got), key=repr) == left


def test_hot_records_are_found_and_bounded(spark):
    frame, _, df, _, fg = make(spark, 7)
    from tidemark.operators import pit

    sides = [pit._spine(frame, "ts", "id"), pit._history(pit.Request(fg, df, ("x",)), 0)]
    hot = hot_records(sides, Skew(target_rows=60, fraction=0.01, min_bytes=0))
    assert [(r["__key"], 1 < len(r["bounds"]) <= 7) for r in hot.collect()] == [(1, True)]
    assert hot_records(sides, Skew(target_rows=10, fraction=0.2, min_bytes=0)).count() == 1
    assert hot_records(sides, Skew(target_rows=10_000, min_bytes=0)) is None
    assert hot_records(sides, Skew()) is None  # too small to be counted


def test_time_zero_edges(spark):
    df, fg = history(spark, [(1, 5, 1.0, 1, 1, False), (1, 6, None, 1, 1, True), (1, 7, 2.0, 1, 1, False)])
    spine = spark.createDataFrame(
        [(at(5), 1), (at(6), 1), (at(7), 1), (at(4), 1), (at(9), 99), (at(9), None), (at(7), 1)], "ts timestamp, id long"
    )
    got = pit_join(spine, "ts", fg, df)
    assert got.count() == 7
    assert rows(got, "id", "ts", "x") == sorted(
        [(1, at(5), 1.0), (1, at(6), None), (1, at(7), 2.0), (1, at(4), None), (99, at(9), None), (None, at(9), None),
         (1, at(7), 2.0)], key=repr)
    strict = pit_join(spine.where("id = 1"), "ts", fg, df, strict=True).where("ts = timestamp'2024-01-01 07:00:00'")
    assert rows(strict, "x") == [(None,), (None,)]


def test_empty_sides(spark):
    df, fg = history(spark, [(1, 5, 1.0, 1, 1, False)])
    spine = spark.createDataFrame([(at(5), 1)], "ts timestamp, id long")
    assert pit_join(spine.limit(0), "ts", fg, df).count() == 0
    assert rows(pit_join(spine, "ts", fg, df.limit(0)), "x") == [(None,)]


def test_two_groups_keep_spine_columns_and_requested_order(spark):
    spine = spark.createDataFrame(
        [("2020-02-01T08:30:00Z", 6, 450), ("2020-02-02T10:15:30Z", 5, 5000), ("2020-02-03T13:20:59Z", 1, 1999),
         ("2021-01-01T00:00:00Z", 1, 2001)],
        "my_event_time string, Id long, HOUSE_ID long",
    )
    customers = spark.createDataFrame(
        [(6, "2020-02-01T00:00:00Z", 11111), (6, "2020-02-01T09:00:00Z", 99999), (5, "2020-02-02T10:15:30Z", 22222),
         (1, "2020-02-02T00:00:00Z", 33333)],
        "Id long, UpdateTime string, ZipCode long",
    )
    payments = spark.createDataFrame(
        [(6, "2020-01-01T00:00:00Z", 1100, 5), (5, "2020-02-01T00:00:00Z", 1600, 6), (1, "2020-01-05T00:00:00Z", 1500, 5),
         (1, "2020-12-05T00:00:00Z", 1100, 5)],
        "Id long, PayTime string, avg_amount long, avg_days_late long",
    )
    housing = spark.createDataFrame(
        [(450, "2020-01-01T00:00:00Z", 2620, 483576), (5000, "2020-01-01T00:00:00Z", 3262, 272467),
         (1999, "2020-01-01T00:00:00Z", 4128, 713124), (2001, "2020-01-01T00:00:00Z", 3126, 473071)],
        "HOUSE_ID long, SaleTime string, SQUARE_FEET long, PRICE long",
    )
    groups = {
        "customers": FeatureGroup.from_frame("customers", customers, "Id", "UpdateTime"),
        "payments": FeatureGroup.from_frame("payments", payments, "Id", "PayTime"),
        "housing": FeatureGroup.from_frame("housing", housing, "HOUSE_ID", "SaleTime"),
    }
    features = ["customers:ZipCode", "housing:*", "payments:avg_amount", "payments:avg_days_late"]
    frames = {"customers": customers, "payments": payments, "housing": housing}
    for skew in (None, Skew(target_rows=1, fraction=1e-5, min_bytes=0)):
        got = get_features(spine, "my_event_time", features, groups, frames, skew=skew)
        assert got.columns == [
            "my_event_time", "Id", "HOUSE_ID", "zipcode", "square_feet", "price", "avg_amount", "avg_days_late"
        ]
        assert rows(got) == [
            ("2020-02-01T08:30:00Z", 6, 450, 11111, 2620, 483576, 1100, 5),
            ("2020-02-02T10:15:30Z", 5, 5000, 22222, 3262, 272467, 1600, 6),
            ("2020-02-03T13:20:59Z", 1, 1999, 33333, 4128, 713124, 1500, 5),
            ("2021-01-01T00:00:00Z", 1, 2001, 33333, 3126, 473071, 1100, 5),
        ]


def test_groups_with_one_key_share_a_shuffle(spark):
    df, fg = history(spark, [(1, 5, 1.0, 1, 1, False)])
    other = df.withColumnRenamed("x", "y")
    og = FeatureGroup.from_frame("o", other, "id", "event_time")
    spine = spark.createDataFrame([(at(5), 1)], "ts timestamp, id long")
    got = get_features(spine, "ts", ["g:x", "o:y"], {"g": fg, "o": og}, {"g": df, "o": other})
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert rows(got, "x", "y") == [(1.0, 1.0)]


def test_same_feature_in_two_groups_gets_a_suffix(spark):
    df, fg = history(spark, [(1, 5, 1.0, 1, 1, False)])
    og = FeatureGroup.from_frame("o", df, "id", "event_time")
    spine = spark.createDataFrame([(at(5), 1)], "ts timestamp, id long")
    got = get_features(spine, "ts", ["g:x", "o:*"], {"g": fg, "o": og}, {"g": df, "o": df})
    assert got.columns == ["ts", "id", "x", "x_1"]


def test_feature_names_are_checked(spark):
    df, fg = history(spark, [])
    assert [f for _, f in parse_features(["g:*"], {"g": fg})] == ["x"]
    for bad in ("x", "g:", "g:nope", "h:x"):
        with pytest.raises(ValueError):
            parse_features([bad], {"g": fg})
    spine = spark.createDataFrame([(at(5), 1, 2.0)], "ts timestamp, id long, x double")
    with pytest.raises(ValueError):
        pit_join(spine, "ts", fg, df)
    assert pit_join(spine, "ts", fg, df, names={"x": "x_then"}).columns == ["ts", "id", "x", "x_then"]
