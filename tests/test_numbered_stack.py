"""A deploy stack of a closure stays in numbers, and is the same as that of its texts."""

import re

import pytest
from pyspark.sql import functions as F

from cascadia.functions import placed
from cascadia.operators import graph as G

DIM = (
    "account_name string, account_path string, account_deps array<string>, min_approval_count int,"
    "min_rejection_count int, voters array<string>, plan_role_arn string, apply_role_arn string"
)


@pytest.fixture(scope="module")
def parts(spark):
    nodes = [("g", d) for d in ("a", "b", "c", "d", "d")] + [("h", "a"), ("h", "b"), ("g", None)]
    # c names its dependencies out of order and one of them twice; x and null are no directories.
    edges = [
        ("g", "b", "a", 0), ("g", "c", "b", 1), ("g", "c", "a", 0), ("g", "c", "d", 2), ("g", "c", "a", 0), ("g", "c", "a", None),
        ("g", "x", "a", 0), ("g", None, "a", 0), ("g", "b", "x", 1), ("g", "d", None, 0), ("h", "b", "a", 0), ("g", "a", "gone", 0),
    ]
    seeds = [("one", "g", "a"), ("one", "g", "a"), ("two", "g", "gone"), ("two", "h", "b"), ("three", "h", "a"), (None, "g", "a"), ("lost", "g", "d")]
    providers = [("g", "a", ["p"]), ("g", "a", ["q"]), ("g", "c", None)]
    dim = [("g", "live/g", [], 1, 1, ["v"], "pa", "aa"), ("h", "live/h", ["g"], 1, 2, [], "pb", "ab")]
    heads = [("one", 1, "trunk", "f"), ("two", 2, "trunk", "f"), ("two", 3, "trunk", "f"), ("three", 4, "trunk", "f"), (None, 5, "t", "f")]
    nodes = spark.createDataFrame(nodes, "graph_id string, cfg_path string")
    edges = spark.createDataFrame(edges, "graph_id string, cfg_path string, dep_path string, pos int")
    seeds = spark.createDataFrame(seeds, "commit_id string, graph_id string, dir string")
    rest = [
        spark.createDataFrame(providers, "graph_id string, cfg_path string, new_providers array<string>"),
        spark.createDataFrame(dim, DIM),
        spark.createDataFrame(heads, "commit_id string, pr_id int, base_ref string, head_ref string"),
    ]
    in_numbers = G.deploy_stack(nodes, edges, G.closure(nodes, edges, seeds), *rest)
    in_texts = G.deploy_stack(nodes, edges, G.impact_closure(nodes, edges, seeds), *rest)
    return in_numbers, in_texts


def _rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def test_the_stack_is_the_same(parts):
    in_numbers, in_texts = parts
    assert _rows(in_numbers.table()) == _rows(in_texts.table())
    assert _rows(in_numbers.table(limit=1)) == _rows(in_texts.table(limit=1))
    assert _rows(in_numbers.long_deps(1)) == _rows(in_texts.long_deps(1))
    assert _rows(in_numbers.runs) == _rows(in_texts.runs)
    assert _rows(in_numbers.deps) == _rows(in_texts.deps)


def test_lists_keep_their_order(parts):
    lists = {(r.commit_id, r.cfg_path): r.cfg_deps for r in parts[0].table().filter("account_name = 'g'").collect()}
    assert lists["one", "c"] == ["a", "a", "a", "b"] and lists["one", "a"] == [] and lists["two", "b"] == ["a", "x"]


def test_rows_and_dependencies_are_numbers(parts):
    kinds = {kind for df in (parts[0].rows, parts[0].edges) for _, kind in df.dtypes}
    assert kinds == {"bigint"}


def test_no_row_of_the_stack_is_hashed(spark, parts):
    # A part of the rows that is measured to be small need not fit into a hash table.
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, "-1")
    try:
        for df in (parts[0].table(), parts[0].runs):
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
            assert re.findall(r"ShuffledHashJoin \[(?:node|dep|commit)#.* Inner, .*", plan) == []
    finally:
        for n, value in zip(names, before):
            spark.conf.set(n, value)


def test_rounds_hash_no_frontier(spark):
    edges = placed.salted(spark.createDataFrame([(1, 2), (2, 1)], "node long, to_node long"), ["node"])
    first = placed.sorted_by(spark.createDataFrame([(7, 1), (7, 2)], "label long, node long"), ["label", "node"])
    seen = placed.Grown(order=["label", "node"])
    seen.add(first)
    found = placed.along(first, edges, ["node"], F.col("label")).select("label", F.col("to_node").alias("node"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        new = placed.unseen(found, seen, ["label", "node"])
        plan = new._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # Frontier and found rows are sorted and moved; edges and what was seen are neither.
    assert "ShuffledHashJoin" not in plan and plan.count("Sort [") == 2 and plan.count("Exchange hash") == 2
    assert new.collect() == []
