import bisect
import math
import random
from datetime import datetime

from helpers import rows
from pyspark.sql import functions as F

from tidemark.model import FeatureGroup
from tidemark.operators import access as A
from tidemark.operators import catalog as C
from tidemark.operators import lineage as O
from tidemark.operators import monitor as M
from tidemark.skew import slice_number
from tidemark.sources import reports as R


def test_profile_has_one_row_per_column(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None), (2.0, None), (None, None)], "a double, b int")
    got = {r["name"]: r for r in M.profile(df).collect()}
    a, b = got["a"], got["b"]
    assert (a["size"], a["missingValuesCount"], a["distinctValuesCount"], a["min"], a["max"]) == (3, 1, 2, 1.0, 2.0)
    assert math.isclose(a["entropy"], -(2 / 3 * math.log(2 / 3) + 1 / 3 * math.log(1 / 3)))
    assert [(v["value"], v["n"]) for v in a["mostCommonValues"]] == [("1.0", 2), ("2.0", 1)]
    assert [(v["bin"], v["n"]) for v in a["valueDistribution"]] == [(0, 2), (9, 1)]
    assert a["minimumValues"] == [1.0, 2.0] and a["zScoreOutliersSample"] is None
    assert (b["size"], b["missingValuesCount"], b["min"]) == (0, 4, None)


def test_profile_of_a_constant_column(spark):
    df = spark.createDataFrame([(5,), (5,)], "a int")
    assert rows(M.profile_histogram(df, ["a"])) == [("a", 0, 2)]
    assert rows(M.profile_zscore(df, ["a"])) == [("a", 0, 2)]
    assert rows(M.profile_entropy(df, ["a"])) == [("a", 1, 0.0)]


def test_reports_are_read_in_order_and_cut_by_date(spark, tmp_path):
    for day in (3, 1, 2):
        R.write_report(M.profile(spark.range(day)), str(tmp_path), "g", datetime(2024, 1, day))
    got = R.read_reports(spark, str(tmp_path), "g")
    assert [r["max"] for r in got.collect()] == [0.0, 1.0, 2.0] and "mostCommonValues" not in got.columns
    assert R.read_reports(spark, str(tmp_path), "g", datetime(2024, 1, 1)).count() == 2
    full, short = R.consolidate_reports(got, str(tmp_path / "csv"), "g")
    assert "valueDistribution" in full.columns and "valueDistribution" not in short.columns
    series = R.feature_series(got, "id", ["max"]).orderBy("written_on").collect()
    assert [r["max_change"] for r in series] == [None, 1.0, 1.0]


def test_drift_rows_continue_the_ids(spark):
    df = spark.createDataFrame([("O0", 1.0), ("O1", 3.0), ("O2", 9.0)], "id string, amount double")
    fg = FeatureGroup.from_frame("g", df, "id", "id")
    assert rows(M.drift_rows(df, fg, 3, "amount", n=2)) == [("O3", -1.0), ("O4", 1.0)]
    assert M.drift_rows(df, fg, 3, "amount", n=None).count() == 3


def test_lineage_depth_and_cycles(spark):
    edges = O.training_run_edges(spark, "run", "model", ["fg1", "fg2"], "src", "proc", "end")
    back = O.edges_frame(spark, [("model", "model", "proc", "processing")])
    edges = edges.unionByName(back)
    assert rows(O.groups_of_model(edges, "model"), "node") == [("fg1",), ("fg2",)]
    assert rows(O.models_of_group(edges, "fg1"), "node") == [("model",)]
    assert rows(O.groups_of_source(edges, "src", 1), "node") == []
    assert rows(O.groups_of_source(edges, "src"), "node") == [("fg1",), ("fg2",)]
    assert rows(O.sources_of_group(edges, "fg2"), "node") == [("src",)]
    found = O.connected(edges, "end")
    assert dict(rows(found, "node", "depth")) == {"model": 1, "run": 2, "fg1": 3, "fg2": 3, "proc": 4, "src": 5}
    assert O.delete_lineage(edges, found).count() == 0
    assert O.reach(edges, "end", "both", 1).count() == 1


def test_recorded_edges_are_read_once(spark, tmp_path):
    edges = O.training_run_edges(spark, "run", "model", ["fg1"])
    for _ in range(2):
        O.record_edges(edges, str(tmp_path / "edges"))
    assert rows(O.read_edges(spark, str(tmp_path / "edges"))) == rows(edges)


def test_catalog_search(spark):
    df = spark.createDataFrame([(1, True, 2.0)], "customer_id long, is_married boolean, x double")
    fg = FeatureGroup.from_frame("customers", df, "customer_id", "x")
    table = C.catalog_frame(spark, [fg], datetime(2024, 1, 1))
    table = C.describe_feature(table, "customers", "x", "a MARRIED thing", {"team": "a"})
    table = C.describe_feature(table, "customers", "x", params={"team": "mlops", "org": "b"})
    assert rows(C.search(table, "married"), "feature_name") == [("is_married",), ("x",)]
    assert rows(C.search(table, "married", scope="name"), "feature_name") == [("is_married",)]
    assert rows(C.search(table, "MLOps"), "feature_name") == [("x",)]
    assert rows(C.search(table, param=("team", "mlops")), "feature_name") == [("x",)]
    assert C.search(table, param=("team", "a")).count() == 0
    assert C.search(table, created_to=datetime(2023, 1, 1)).count() == 0
    assert rows(C.list_groups(table, "CUST")) == [("customers", 3)]


def test_cell_filter_may_use_a_hidden_column(spark):
    df = spark.createDataFrame([("C1", "f"), ("C2", "m")], "id string, sex string")
    assert rows(A.cell_filter(df, "sex = 'f'", exclude=["sex"])) == [("C1",)]
    assert A.column_filter(df, include=["id"]).columns == ["id"]


def test_slice_number_counts_bounds(spark):
    rng = random.Random(2)
    for size in (1, 63, 64, 65, 300):
        bounds = sorted(rng.sample(range(1000), size))
        frame = spark.createDataFrame([(v, bounds) for v in range(-1, 1001, 7)], "v long, bounds array<long>")
        frame = frame.withColumn("coarse", F.filter("bounds", lambda _, i: i % 64 == 0))
        got = frame.select("v", slice_number(F.col("v")).alias("s")).collect()
        assert all(r.s == bisect.bisect_right(bounds, r.v) for r in got)
