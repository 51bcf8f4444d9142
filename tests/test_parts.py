"""Parts that one task solves give what rounds give, in as many jobs however deep a graph is."""

import random

import pytest

from cascadia.functions.parts import strong_parts
from cascadia.operators import graph as G

EDGES = "graph_id string, cfg_path string, dep_path string"


def _rows(df):
    return sorted(map(repr, df.collect()))


def _jobs(spark, action):
    context = spark.sparkContext
    name = f"parts-{random.random()}"
    context.setJobGroup(name, name)
    try:
        action()
        return len(context.statusTracker().getJobIdsForGroup(name))
    finally:
        context._jsc.clearJobGroup()


@pytest.fixture(scope="module")
def edges(spark):
    pick = random.Random(4)
    rows = [(f"g{g}", f"d{pick.randrange(9)}", f"d{pick.randrange(9)}") for g in range(25) for _ in range(g % 13)]
    odd = [("g1", None, "d1"), ("g1", "d1", None), (None, "a", "b"), (None, "b", "a"), ("g2", "x", "x"), ("g2", "x", "x"), ("g3", "\uffff", "\U0001f600"), ("g3", "\U0001f600", "\uffff")]
    return spark.createDataFrame(rows + odd, EDGES)


@pytest.mark.parametrize("part", [5])
def test_cycles_as_in_rounds(edges, part):
    assert _rows(G.cycle_members(edges)) == _rows(G.cycle_members(edges, part=part))


def test_a_long_cycle_takes_few_jobs(spark):
    chain = [("g", f"d{i:02}", f"d{i + 1:02}") for i in range(40)] + [("g", "d40", "d20"), ("g", "d30", "d29")]
    df, got = spark.createDataFrame(chain, EDGES), []
    assert _jobs(spark, lambda: got.extend(G.cycle_members(df).collect())) < 20
    assert {tuple(r) for r in got} == {("g", f"d{i}", "d40") for i in range(20, 41)}


def _random_runs(seed):
    pick, rows = random.Random(seed), []
    for commit in range(12):
        for run in range(pick.randrange(1, 9)):
            some = lambda kind, n: pick.sample([f"{kind}{i}" for i in range(9)], n)
            row = dict(
                execution_id=f"r{commit}-{run}", commit_id=f"c{commit}" if commit else None, is_rollback=commit % 5 == 4,
                status=pick.choice(["waiting"] * 8 + ["running", "failed", "aborted", "succeeded"]),
                cfg_path=pick.choice([f"d{run}", f"d{run}", f"d{run}", None]), account_name=f"a{pick.randrange(4)}",
                cfg_deps=None if pick.random() < 0.08 else some("d", pick.randrange(3)),
                account_deps=None if pick.random() < 0.05 else some("a", pick.choice([0, 0, 0, 1])),
            )
            rows += [row] * pick.choice([1, 1, 1, 2])
    return rows


@pytest.mark.parametrize("seed", [1])
def test_reasons_as_in_rounds(make_runs, seed):
    runs = make_runs(*_random_runs(seed))
    got = _rows(G.blocked_reasons(runs))
    assert got and got == _rows(G.blocked_reasons(runs, part=0))


def test_reasons_of_long_lists_and_of_ids_that_are_no_keys(spark, make_runs):
    rows = _random_runs(5)
    # One id in two commits, one in two states, one null: their commits are left to rounds.
    rows += [dict(rows[0], commit_id="c5"), dict(rows[0], commit_id="c6", execution_id=None)]
    rows += [dict(commit_id="c7", execution_id="twice", status=s, cfg_path="d1", cfg_deps=["d2"]) for s in ("waiting", "failed")]
    runs = make_runs(*rows)
    deps = spark.createDataFrame([(r["execution_id"], d) for r in rows[::3] for d in ("d1", "d3", None)], "execution_id string, dep_path string")
    got = _rows(G.blocked_reasons(runs, deps))
    assert got and got == _rows(G.blocked_reasons(runs, deps, part=0))


def test_reasons_take_few_jobs(spark, make_runs):
    chain = [dict(execution_id=f"r{i}", cfg_path=f"d{i}", cfg_deps=[f"d{i + 1}"], account_name=f"a{i}") for i in range(30)]
    runs, got = make_runs(*chain, dict(execution_id="r30", cfg_path="d30", cfg_deps=["d20"])), []
    assert _jobs(spark, lambda: got.extend(G.blocked_reasons(runs).collect())) < 25
    assert {(r.execution_id, r.on_cycle, r.behind_cycle) for r in got} == {(f"r{i}", i >= 20, i < 20) for i in range(31)}


def test_parts_come_after_what_they_lead_to():
    part = strong_parts([[1], [2, 3], [1], [4], [4], []])
    assert part[1] == part[2] and part[0] > part[1] > part[3] > part[4] and len(set(part)) == 5
