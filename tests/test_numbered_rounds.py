"""Rounds of the fixpoints move and store numbers, not texts."""

from cascadia.functions import placed
from cascadia.operators import graph as G


def _stored(monkeypatch):
    frames, cut = [], placed.cut
    monkeypatch.setattr(placed, "cut", lambda df: frames.append(df) or cut(df))
    return frames


def _kinds(frames):
    return {kind for df in frames for _, kind in df.dtypes} - {"int", "boolean", "bigint"}


def test_closure_moves_numbers(spark, monkeypatch):
    frames = _stored(monkeypatch)
    nodes = spark.createDataFrame([("g", "a"), ("g", "b")], "graph_id string, cfg_path string")
    edges = spark.createDataFrame(
        [("g", "b", "a"), ("g", None, "b"), ("g", "x", None), ("g", "b", "gone")], "graph_id string, cfg_path string, dep_path string"
    )
    seeds = spark.createDataFrame(
        [("c", "g", "a"), ("c", "g", "a"), (None, "g", "gone"), ("d", None, "a"), ("d", "g", None)], "commit_id string, graph_id string, dir string"
    )
    got = {tuple(r) for r in G.impact_closure(nodes, edges, seeds).collect()}
    assert got == {("c", "g", "a"), ("c", "g", "b"), ("c", "g", None), (None, "g", "b"), (None, "g", None)}
    assert _kinds(frames) == set()


def test_cycles_move_numbers(spark, monkeypatch):
    frames = _stored(monkeypatch)
    edges = spark.createDataFrame(
        [("g", "a", "b"), ("g", "b", "a"), ("h", "a", "b"), ("g", "c", "a"), ("g", "d", "d")], "graph_id string, cfg_path string, dep_path string"
    )
    got = {tuple(r) for r in G.cycle_members(edges).collect()}
    assert got == {("g", "a", "b"), ("g", "b", "b"), ("g", "d", "d")}
    assert _kinds(frames) == set()
