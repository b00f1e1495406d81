"""Flow documents: a graph of sources and transforms as JSON, read into one lazy plan.

A document lists nodes: an id, an operator, parameters, and inputs that name other nodes
(`{"node_id": …}`, or the id alone). Operators are looked up by their last name part without its version, so
`vendor.infer_and_cast_type_0.1` is `infer_and_cast_type`. Nodes are put in order of their inputs, whatever
their order in the document; an unknown operator, an input that isn't there, two nodes
of one id, a wrong number of inputs or a cycle is an error before anything is read.
Every node's result is a DataFrame, so a node used twice is planned twice and Spark shares what it can.

Sources name a dataset; the caller maps names to frames or gives a reader. New operators
are added by `operators=`.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import transforms as T

Step = Callable[[Sequence[DataFrame], Mapping[str, Any]], DataFrame]


@dataclass(frozen=True)
class Node:
    """One node of a flow: its operator without prefix and version, and the ids of its inputs in order."""

    id: str
    operator: str
    parameters: Mapping[str, Any] = field(default_factory=dict)
    inputs: tuple[str, ...] = ()


def _one(fn: Callable[..., DataFrame]) -> tuple[int, Step]:
    return 1, lambda inputs, p: fn(inputs[0], p)


def _typed(df: DataFrame, p: Mapping[str, Any]) -> DataFrame:
    """Cast as the document was trained to, else as the values suggest; columns that aren't there are left out."""
    types = {c: _SPARK_TYPES.get(t, t) for c, t in (p.get("schema") or {}).items() if c in df.columns}
    return T.cast_columns(df, types) if types else T.infer_and_cast(df)


_SPARK_TYPES = {"bool": "boolean", "long": "bigint", "float": "double"}

#: Operator: how many inputs it takes, and what it does.
OPERATORS: dict[str, tuple[int, Step]] = {
    "infer_and_cast_type": _one(_typed),
    "cast_single_data_type": _one(lambda df, p: T.cast_columns(df, {p["column"]: _SPARK_TYPES.get(p["data_type"], p["data_type"])})),
    "cast": _one(lambda df, p: T.cast_columns(df, p["types"])),
    "drop": _one(lambda df, p: df.drop(*p["columns"])),
    "select": _one(lambda df, p: df.select(*p["columns"])),
    "rename": _one(lambda df, p: df.withColumnsRenamed(p["names"])),
    "filter": _one(lambda df, p: df.where(p["condition"])),
    "custom_formula": _one(lambda df, p: df.withColumn(p["output_column"], F.expr(p["formula"]))),
    "custom_sql": _one(lambda df, p: df.sparkSession.sql(p["sql"], df=df)),  # the input is {df}
    "ordinal_encode": _one(lambda df, p: T.encode_many(df, p["columns"], p.get("order", "freq"))),
    "one_hot_encode": _one(lambda df, p: T.one_hot(df, p["column"], p.get("prefix", p["column"]))),
    "scale_minmax": _one(lambda df, p: T.minmax(df, p["columns"], p.get("decimals"))),
    "scale_standard": _one(lambda df, p: T.standard_scale(df, p["columns"])),
    "bucketize": _one(lambda df, p: T.bucketize(df, p["column"], p["edges"], p["labels"], p.get("output"))),
    "days_since": _one(lambda df, p: T.days_since_scaled(df, p["column"], p["output"], p["as_of"], p.get("decimals"))),
    "join": (2, lambda inputs, p: inputs[0].join(inputs[1], p["on"], p.get("how", "inner"))),
    "concatenate": (2, lambda inputs, p: inputs[0].unionByName(inputs[1], allowMissingColumns=True)),
}


def parse_flow(document: str | Mapping[str, Any]) -> list[Node]:
    """The nodes of a document."""
    given = json.loads(document) if isinstance(document, str) else document
    nodes = []
    for n in given["nodes"]:
        inputs = tuple(i if isinstance(i, str) else i["node_id"] for i in n.get("inputs") or ())
        # what was learned when the flow was made belongs to the parameters
        parameters = {**(n.get("parameters") or {}), **(n.get("trained_parameters") or {})}
        operator = "source" if str(n.get("type", "")).upper() == "SOURCE" else re.sub(r"_\d+(\.\d+)*$", "", n["operator"]).rsplit(".", 1)[-1]
        nodes.append(Node(n["node_id"], operator, parameters, inputs))
    return nodes


def ordered(nodes: Sequence[Node]) -> list[Node]:
    """The nodes, each after its inputs."""
    by_id = {n.id: n for n in nodes}
    if len(by_id) < len(nodes):
        raise ValueError("two nodes of the flow have the same id")
    for n in nodes:
        if missing := [i for i in n.inputs if i not in by_id]:
            raise ValueError(f"node {n.id!r} takes {missing[0]!r}, which isn't in the flow")
    out: list[Node] = []
    left = list(nodes)
    while left:
        done = {n.id for n in out}
        ready = [n for n in left if done.issuperset(n.inputs)]
        if not ready:
            raise ValueError(f"the flow has a cycle through {sorted(n.id for n in left)}")
        out += ready
        left = [n for n in left if n not in ready]
    return out


def dataset_name(parameters: Mapping[str, Any]) -> str:
    """The name a source gives its dataset."""
    definition = parameters.get("dataset_definition", parameters)
    return definition["name"]


def run_document(
    document: str | Mapping[str, Any],
    sources: Mapping[str, DataFrame] | Callable[[str, Mapping[str, Any]], DataFrame],
    output: str | None = None,
    operators: Mapping[str, tuple[int, Step]] | None = None,
) -> DataFrame:
    """The frame of one node, by default of the only node that no other takes."""
    known = {**OPERATORS, **(operators or {})}
    nodes = ordered(parse_flow(document))
    for n in nodes:
        if n.operator != "source" and n.operator not in known:
            raise ValueError(f"node {n.id!r} has the unknown operator {n.operator!r}")
        wanted = 0 if n.operator == "source" else known[n.operator][0]
        if len(n.inputs) != wanted:
            raise ValueError(f"node {n.id!r} takes {len(n.inputs)} inputs; {n.operator!r} needs {wanted}")
    if output is None:
        taken = {i for n in nodes for i in n.inputs}
        last = [n.id for n in nodes if n.id not in taken]
        if len(last) != 1:
            raise ValueError(f"the flow ends in {last}; name one of them as the output")
        output = last[0]
    elif output not in {n.id for n in nodes}:
        raise ValueError(f"the flow has no node {output!r}")
    needed = _upstream(nodes, output)
    frames: dict[str, DataFrame] = {}
    for n in nodes:
        if n.id not in needed:
            continue
        if n.operator == "source":
            name = dataset_name(n.parameters)
            frames[n.id] = sources(name, n.parameters) if callable(sources) else sources[name]
        else:
            frames[n.id] = known[n.operator][1]([frames[i] for i in n.inputs], n.parameters)
    return frames[output]


def _upstream(nodes: Sequence[Node], output: str) -> set[str]:
    wanted = {output}
    for n in reversed(nodes):
        if n.id in wanted:
            wanted.update(n.inputs)
    return wanted
