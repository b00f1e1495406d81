import random
from collections import Counter

import pytest
from helpers import rows
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from tidemark.functions import records as R
from tidemark.functions import scalar as S
from tidemark.functions import transforms as T
from tidemark.model import FeatureGroup, feature_type
from tidemark.operators import learn as N


def test_encoders_disagree_on_a_frequent_one(spark):
    df = spark.createDataFrame([(1,), (1,), (0,), (None,)], "v int")
    assert rows(T.ordinal_encode(df, "v", "freq", "o")) == [(0, 1), (1, 0), (1, 0), (None, None)]
    assert rows(T.ordinal_encode(df, "v", "alpha", "o")) == [(0, 0), (1, 1), (1, 1), (None, None)]
    with pytest.raises(ValueError):
        T.ordinal_encode(df, "v", "size")


def test_many_columns_share_one_dictionary(spark):
    rng = random.Random(1)
    data = [(n, rng.choice([None, "b", "a", "É", "a b"]), rng.choice([None, 10, 9, -1]), rng.randrange(300), None) for n in range(900)]
    df = spark.createDataFrame(data, "n long, s string, i int, many int, none string")
    for order in ("freq", "alpha"):
        found = {r["n"]: r for r in T.encode_many(df, ["s", "i", "many", "none"], order).collect()}
        for k, c in enumerate(["s", "i", "many", "none"], 1):
            counts = Counter(str(r[k]) for r in data if r[k] is not None)
            places = {v: i for i, v in enumerate(sorted(counts, key=lambda v: (-counts[v] if order == "freq" else 0, v.encode())))}
            assert all(found[r[0]][c] == (None if r[k] is None else places[str(r[k])]) for r in data)
    mixed = T.dictionary(df, {"s": "alpha", "i": "freq"})
    assert rows(mixed.where("name = 's'"), "label", "label_index") == rows(T.ordinal_labels(df, "s", "alpha"))
    assert rows(mixed.where("name = 'i'"), "label", "label_index") == rows(T.ordinal_labels(df, "i", "freq"))
    assert T.encode_many(df, []).columns == df.columns and T.encode_many(df.limit(0), ["s"]).collect() == []


def test_one_scan_fits_all_columns(spark, tmp_path):
    spark.range(50).selectExpr("cast(id % 3 as string) a", "cast(id % 5 as string) b", "id").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    texts = stored.select("a", "b").unpivot([], ["a", "b"], "name", "label")
    assert texts._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert T.dictionary(stored, ["a", "b"]).count() == 8


def test_sparse_vectors_of_many_columns(spark):
    df = spark.createDataFrame([(1, "b", 5), (2, "a", None), (3, None, 5), (4, "b", 6)], "n int, s string, k int")
    found = {r["n"]: r for r in T.encode_many(df, ["s", "k"], "alpha", vectors=True).collect()}
    assert found[1]["s"] == SparseVector(2, {1: 1.0}) and found[3]["s"] == SparseVector(2, {}) and found[2]["s"] == SparseVector(2, {0: 1.0})
    assert [found[n]["k"].toArray().tolist() for n in (1, 2, 4)] == [[1, 0], [0, 0], [0, 1]]


def test_row_positions_are_exact(spark):
    df = spark.range(1000).repartition(7).withColumn("k", F.xxhash64("id"))
    got = T.row_positions(df, [F.col("k")], "p").orderBy("p").collect()
    assert [r.p for r in got] == list(range(1000)) and [r.k for r in got] == sorted(r.k for r in got)


def test_scaling_edges(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (3.0, 5.0, None), (None, None, None)], "a double, b double, c double")
    assert rows(T.minmax(df, ["a", "b", "c"])) == [(0.0, 0.5, None), (1.0, 0.5, None), (None, None, None)]
    assert rows(T.minmax(df, "b", constant=0.0), "b") == [(0.0,), (0.0,), (None,)]
    assert rows(T.standard_scale(df, ["a", "b", "c"])) == [(-1.0, 0.0, None), (1.0, 0.0, None), (None, None, None)]


def test_age_bins(spark):
    df = spark.createDataFrame([(a,) for a in (17, 18, 30, 31, 90, 91, None)], "age int")
    got = {r.age: r.r for r in T.bucketize(df, "age", output="r").collect()}
    assert got == {17: None, 18: "18-29", 30: "18-29", 31: "30-39", 90: "70-plus", 91: None, None: None}


def test_one_hot_with_spaces_and_nulls(spark):
    df = spark.createDataFrame([("a b",), ("c",), (None,)], "v string")
    got = T.one_hot(df, "v", "k")
    assert got.columns == ["k_a_b", "k_c"] and rows(got) == [(0, 0), (0, 1), (1, 0)]


def test_type_inference(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "2020-01-01 00:00:00", "x", None), (None, "2", "2021-01-01", "1", None)],
        "i string, d string, t string, s string, n string",
    )
    assert T.infer_types(df) == {"i": "bigint", "d": "double", "t": "timestamp", "s": "string", "n": "string"}
    assert [f.dataType.simpleString() for f in T.infer_and_cast(df).schema] == ["bigint", "double", "timestamp", "string", "string"]
    late = spark.range(3000).select(F.when(F.col("id") == 2999, "x").otherwise(F.col("id").cast("string")).alias("v"))
    assert T.infer_types(late) == {"v": "string"}


def test_scalars(spark):
    df = spark.createDataFrame([("a$b?&#", 0)], "t string, e long")
    got = df.select(
        S.tag_escape(F.col("t")), S.epoch_to_iso(F.col("e")), S.days_since(F.lit("2020-01-01 00:01:01"), "2020-01-31"),
        S.year_month(F.lit("2020-01-31").cast("date")), S.parse_ts(F.lit("bad")), S.prefixed_id("O", F.col("e")),
        S.iso8601(F.lit("2020-01-01 00:00:00.1239").cast("timestamp")),
    ).first()
    assert tuple(got) == ("a_D_b_Q__A__H_", "1970-01-01T00:00:00Z", 30, "2020-1", None, "O0", "2020-01-01T00:00:00.123Z")


def test_day_list_sizes(spark):
    df = spark.createDataFrame([(0.0, 1), (0.35, 2), (1.0, 3), (None, 4)], "s double, k long")
    assert [r[0] for r in df.select(F.size(S.day_list(F.col("s"), F.col("k"))).alias("n")).collect()][:3] == [0, 3, 10]
    assert df.where("s is null").select(S.day_list(F.col("s"), F.col("k"))).first()[0] is None


def test_record_round_trip_keeps_empty_and_null_lists_apart(spark):
    df = spark.createDataFrame(
        [(1, 1.5, "a", ["x", "y"]), (2, None, "None", []), (3, 2.0, None, None)],
        "id long, v double, s string, l array<string>",
    )
    fg = FeatureGroup.from_frame("g", df, "id", "id")
    records = R.to_records(df, fg)
    assert rows(R.from_records(records, fg)) == rows(df)
    assert rows(R.long_to_rows(R.records_long(records), fg)) == rows(df)
    assert R.records_long(records).count() == 9
    assert R.from_records(records, fg, ["s"]).columns == ["s"]


def test_feature_types(spark):
    df = spark.sql("select 1Y a, 1.5BD b, true c, date'2020-01-01' d, array('x') e, 1F f")
    assert [feature_type(f.dataType) for f in df.schema] == ["Integral", "Fractional", "String", "String", "String", "Fractional"]
    fg = FeatureGroup.declared("g", [("i", "long"), ("f", "float"), ("t", "date")], "i", "t")
    assert [d["feature_type"] for d in fg.definitions()] == ["Integral", "Fractional", "String"]
    with pytest.raises(ValueError):
        FeatureGroup.declared("g", [("i", "long")], "i", "t")
    assert fg.tag(a="1").tag(a="2").tags == {"a": "2"}
    assert fg.add_feature("n", df.schema[0].dataType).names == ["i", "f", "t", "n"]


@pytest.mark.parametrize("n", [1, 10, 997])
@pytest.mark.parametrize("fetch", [2, 10_000])
def test_split_has_exact_sizes(spark, monkeypatch, n, fetch):
    monkeypatch.setattr(N, "_FETCH", fetch)
    got = {r["split"]: r["count"] for r in N.split(spark.range(n), "id").groupBy("split").count().collect()}
    wanted = {"train": int(0.7 * n), "validation": int(0.9 * n) - int(0.7 * n), "test": n - int(0.9 * n)}
    assert got == {k: v for k, v in wanted.items() if v}


def test_foreign_model_and_decision(spark):
    df = spark.createDataFrame([(1, "t", 0.2, 0.2), (2, "t", 0.5, 0.15)], "id long, ts string, a double, b double")
    scored = N.score_foreign(df, lambda: 1.0, lambda m, x: x["a"] + m * x["b"])
    decided = N.decide(scored, "prediction_score", 0.65, "standard", "discount")
    assert rows(decided, "id", "decision") == [(1, "standard"), (2, "discount")]


def test_training_passes_over_distinct_rows(spark, monkeypatch):
    seen = []

    class Trees(N.GBTClassifier):
        def _fit(self, dataset):
            seen.append(dataset.count())
            return super()._fit(dataset)

    monkeypatch.setattr(N, "GBTClassifier", Trees)
    a, b = F.pmod(F.xxhash64("id"), F.lit(7)), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3))
    df = spark.range(5000).select("id", F.when(a < 6, a).alias("a"), b.cast("double").alias("b"), F.lit(1).alias("c"))
    df = df.withColumn("y", ((F.coalesce("a", F.lit(0)) + F.col("b") > 4) != (F.col("id") % 10 == 0)).cast("int"))
    model = N.train_classifier(df, "y", ["a", "b", "c"], rounds=5)
    assert seen == [2 * 6 * 3]  # a null is a zero
    plain = GBTClassifier(labelCol="y", featuresCol="v", maxIter=5, seed=123)
    rows = VectorAssembler(inputCols=["a", "b", "c"], outputCol="v").transform(df.fillna(0, ["a"]))
    wanted = plain.fit(rows).transform(rows).select("id", vector_to_array("probability")[1].alias("wanted"))
    scored = N.score(model, df, ["a", "b", "c"])
    assert scored.columns == [*df.columns, "prediction_score"] and scored.count() == 5000
    assert scored.join(wanted, "id").where(F.abs(F.col("prediction_score") - F.col("wanted")) > 1e-6).isEmpty()


def test_many_values_are_binned_by_quantiles(spark):
    df = spark.range(20_000).select((F.col("id") * 1.0).alias("x"), F.lit(None).cast("double").alias("z"), (F.col("id") % 40).alias("w"))
    x, z, w = N._bin_edges(df.fillna(0, ["z"]), ["x", "z", "w"])
    assert len(x) == 33 and all(abs(e - 625 * (i + 1)) < 10 for i, e in enumerate(x[1:-1]))
    assert z == [float("-inf"), 0.0, float("inf")] and len(w) <= 33
