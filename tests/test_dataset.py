from helpers import at, history, rows

from tidemark.model import FeatureGroup
from tidemark.operators import dataset as D


def test_builder_joins_history_rows_and_numbers_names(spark):
    df, fg = history(spark, [(1, 1, 1.0, 1, 1, False), (1, 2, 2.0, 2, 2, False), (2, 1, 5.0, 1, 1, False)])
    base = spark.createDataFrame([(1, at(9), 7.0), (3, at(9), 8.0)], "id long, ts timestamp, x double")
    made = D.create_dataset(base, "id", "ts").with_feature_group(fg, df, columns=["x"])
    assert rows(made.to_dataframe(), "id", "x", "x_1") == [(1, 7.0, 1.0), (1, 7.0, 2.0)]
    left = D.create_dataset(base, "id", "ts").with_feature_group(fg, df, how="left").to_dataframe()
    assert left.columns == ["id", "ts", "x", "id_1", "event_time", "x_1"] and left.count() == 3


def test_builder_time_limits(spark):
    df, fg = history(spark, [(1, 1, 1.0, 1, 1, False), (1, 2, 2.0, 8, 2, False), (1, 3, 3.0, 3, 3, False)])
    base = spark.createDataFrame([(1, at(2))], "id long, ts timestamp")
    made = D.create_dataset(base, "id", "ts").with_feature_group(fg, df, columns=["x"])
    assert rows(made.as_of(at(4)).to_dataframe(), "x") == [(1.0,), (3.0,)]
    assert rows(made.with_event_time_range(at(2), at(3)).to_dataframe(), "x") == [(2.0,), (3.0,)]
    assert rows(made.with_event_time_range(end=at(1)).to_dataframe(), "x") == []
    assert rows(made.point_in_time_accurate_join().to_dataframe(), "x") == [(2.0,)]
    assert rows(made.point_in_time_accurate_join(strict=True).to_dataframe(), "x") == [(1.0,)]
    recent = made.with_number_of_recent_records_by_record_identifier(2)
    assert rows(recent.to_dataframe(), "x") == [(2.0,), (3.0,)]
    assert rows(recent.point_in_time_accurate_join().to_dataframe(), "x") == [(1.0,), (2.0,)]


def test_builder_on_a_group_and_csv(spark, tmp_path):
    df, fg = history(spark, [(1, 1, 1.0, 1, 1, False), (1, 2, 2.0, 2, 2, False)])
    assert D.create_dataset(df, fg=fg).to_dataframe().count() == 2
    D.create_dataset(df, fg=fg).to_csv(str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 2


def test_featureset_keeps_missing_ids_and_order(spark):
    df, fg = history(spark, [(1, 1, 1.0, 1, 1, False)])
    other = df.select("id", "event_time", df.x.alias("y"))
    og = FeatureGroup.from_frame("o", other, "id", "event_time")
    ids = spark.createDataFrame([(1,), (1,), (9,)], "id long")
    got = D.latest_featureset(ids, ["o:y", "g:x", "o:y"], {"g": fg, "o": og}, {"g": df, "o": other})
    assert got.columns == ["id", "y", "x"]
    assert rows(got) == [(1, 1.0, 1.0), (1, 1.0, 1.0), (9, None, None)]
    assert rows(D.batch_get(df, fg, ids), "id") == [(1,)]


def test_suffixes():
    assert D.suffixed(["a", "b", "a_1"], ["a", "c", "B"]) == {"a": "a_2", "c": "c", "B": "B_1"}
