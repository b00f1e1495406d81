"""Flow documents, reports of differing columns, and reach by doubled paths."""

import json
import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators import flow as W
from tidemark.operators import lineage as O
from tidemark.sources import reports as R


def node(name, operator="drop", inputs=(), **parameters):
    return {"node_id": name, "operator": operator, "parameters": parameters, "inputs": [{"node_id": i} for i in inputs]}


def source(name):
    return {"node_id": name, "type": "SOURCE", "operator": "source_0.1", "parameters": {"dataset_definition": {"name": f"{name}.csv"}}, "inputs": []}


def test_a_flow_runs_in_the_order_of_its_inputs(spark):
    a = spark.createDataFrame([("1", "x"), ("2", "y")], "k string, v string")
    b = spark.createDataFrame([(1, 5.0), (2, 7.0)], "k long, w double")
    flow = {"nodes": [
        node("sql", "a.b.custom_sql_1.0", ["both"], sql="select *, w * 2 as doubled from {df}"),
        node("both", "join_0.1", ["typed", "b"], on="k"),
        node("typed", "infer_and_cast_type_0.1", ["a"]),
        source("b"), source("a"), node("more", "concatenate_0.1", ["sql", "sql"]),
        node("few", "custom_formula", ["more"], output_column="up", formula="upper(v)"),
        node("end", "rename", ["kept"], names={"up": "V"}), node("kept", "filter", ["few"], condition="doubled > 10"),
    ]}
    found = W.run_document(json.dumps(flow), {"a.csv": a, "b.csv": b})
    assert found.columns == ["k", "v", "w", "doubled", "V"] and rows(found) == [(2, "y", 7.0, 14.0, "Y")] * 2
    assert rows(W.run_document(flow, lambda name, p: {"a.csv": a, "b.csv": b}[name], output="typed")) == [(1, "x"), (2, "y")]
    encoded = W.run_document({"nodes": [source("a"), node("e", "ordinal_encode", ["a"], columns=["v"], order="alpha")]}, {"a.csv": a})
    assert rows(encoded) == [("1", 0), ("2", 1)]
    own = W.run_document({"nodes": [source("a"), node("x", "my.own_2", ["a"], n=1)]}, {"a.csv": a}, operators={"own": (1, lambda inputs, p: inputs[0].limit(p["n"]))})
    assert own.count() == 1


@pytest.mark.parametrize("nodes, message", [
    ([source("a"), node("x", "no_such", ["a"])], "unknown operator 'no_such'"),
    ([source("a"), node("x", "drop", ["b"], columns=[])], "isn't in the flow"),
    ([node("x", "drop", ["y"], columns=[]), node("y", "drop", ["x"], columns=[]), source("a")], "cycle"),
    ([source("a"), source("a")], "same id"),
    ([source("a"), source("b")], "name one of them"),
    ([source("a"), node("x", "join", ["a"], on="k")], "needs 2"),
])
def test_wrong_flows_are_refused_before_anything_is_read(nodes, message):
    def untouched(name, parameters):
        raise AssertionError("read")

    with pytest.raises(ValueError, match=message):
        W.run_document({"nodes": nodes}, untouched)
    with pytest.raises(ValueError):
        W.run_document({"nodes": nodes}, untouched, output="z")


def test_statistics_that_differ_by_run(spark, tmp_path):
    path = str(tmp_path)
    one = spark.createDataFrame([("a", 1, 2.5, [1.0]), ("b", 3, None, None)], "name string, size long, mean double, minimumValues array<double>")
    R.write_report(one, path, "g", "2024-01-01 00:00:00")
    two = spark.createDataFrame([("a", "many", True, 7)], "name string, size string, odd boolean, `x.y z` int")
    R.write_report(two, path, "g", "2024-01-02 00:00:00")
    (tmp_path / "g" / "broken.json").write_text("{not json")
    found = R.read_reports_variant(spark, path, "g")
    got = {(r["name"], r["written_on"].day): r for r in found.withColumn("size", F.to_json("size")).withColumn("minimumValues", F.to_json("minimumValues")).collect()}
    assert sorted(got) == [("a", 1), ("a", 2), ("b", 1)]
    assert got["a", 1]["size"] == "1" and got["a", 2]["size"] == '"many"' and got["a", 1]["mean"] == 2.5 and got["a", 2]["mean"] is None
    assert got["a", 2]["odd"] is True and got["a", 2]["x.y z"] == 7.0 and got["a", 1]["minimumValues"] == "[1]"
    assert R.read_reports_variant(spark, path, "g", after="2024-01-01 12:00:00").count() == 1
    full, short = R.consolidate_reports(found, f"{path}/csv", "g")
    assert "minimumValues" not in short.columns and spark.read.option("sep", ";").option("header", True).csv(f"{path}/csv/g-full").count() == 3


def nearest(edges, start, up):
    found, frontier, depth = {}, {start}, 0
    while frontier:
        depth += 1
        frontier = {(a if up else b) for a, b in edges if (b if up else a) in frontier} - set(found) - {start}
        found.update(dict.fromkeys(frontier, depth))
    return found


@pytest.mark.parametrize("seed", range(3))
def test_reach_is_breadth_first_search(spark, seed):
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(20)] + [(rng.randrange(26), rng.randrange(26)) for _ in range(8)] + [(3, 3)]
    frame = O.edges_frame(spark, [(f"n{a}", "k", f"n{b}", "k") for a, b in edges])
    for up, start in ((False, 0), (True, 20)):
        wanted = nearest(edges, start, up)
        found = O.reach(frame, f"n{start}", "up" if up else "down")
        assert rows(found, "node", "depth") == sorted(((f"n{n}", d) for n, d in wanted.items()), key=repr)
    for most in (0, 1, 4, 7, 9):
        near = O.reach(frame, "n0", "down", most)
        assert rows(near, "node", "depth") == sorted(((f"n{n}", d) for n, d in nearest(edges, 0, False).items() if d <= most), key=repr)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    plain = O.durable
    monkeypatch.setattr(O, "durable", lambda df, label="stage": rounds.append(label) or plain(df, label))
    chain = spark.range(1000).select(F.concat(F.lit("n"), "id").alias("src"), F.lit("k").alias("src_kind"), F.concat(F.lit("n"), F.col("id") + 1).alias("dst"), F.lit("k").alias("dst_kind"))
    found = O.reach(chain, "n0", "down")
    assert found.count() == 1000 and found.agg(F.max("depth")).first()[0] == 1000
    # the start of the doubling is no round, as it follows no edge
    assert rounds.count("reach") - 1 <= 12


def test_two_kinds_of_a_node(spark):
    frame = O.edges_frame(spark, [("a", "x", "b", "y"), ("b", "z", "c", "y"), ("q", "x", "c", "w"), ("a", "x", "q", "x")])
    assert rows(O.reach(frame, "a", "down")) == [("b", "y", 1), ("c", "w", 2), ("c", "y", 2), ("q", "x", 1)]


def test_steps_move_nodes_and_not_edges(spark, monkeypatch):
    plans, plain = [], O.durable

    def written(df, label="stage"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, label)

    monkeypatch.setattr(O, "durable", written)
    frame = O.edges_frame(spark, [(f"n{i}", "k", f"n{i + 1}", "k") for i in range(5)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert O.reach(frame, "n0", "down").count() == 5
        tables = spark.catalog.listTables()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert all("hashpartitioning(src#" not in p for p in plans) and all("Bucketed: true" in p for p in plans)
    assert not [t for t in tables if t.name.startswith("hop_")]
