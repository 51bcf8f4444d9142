"""Closure, waves, cycles and their reasons on random graphs, and what a round moves."""

import random

import pytest

from cascadia.functions import placed
from cascadia.functions.placed import Grown, dealt, unseen
from cascadia.operators import graph as G
from cascadia.streaming.frontier import ReadyRuns


def closure(edges, start):
    seen, stack = set(start), list(start)
    while stack:
        for n in edges.get(stack.pop(), ()):
            if n not in seen:
                seen.add(n)
                stack.append(n)
    return seen


def successors(pairs):
    out = {}
    for a, b in pairs:
        out.setdefault(a, set()).add(b)
    return out


def components(pairs):
    """Greatest node of each node's cycle, for nodes on one."""
    out = successors(pairs)
    nodes = {n for p in pairs for n in p}
    after = {n: closure(out, out.get(n, ())) for n in nodes}
    return {n: max([n, *(m for m in after[n] if n in after[m])]) for n in nodes if n in after[n]}


@pytest.mark.parametrize("n, m", [(40, 48), (30, 90)])
def test_strong_components(spark, n, m):
    rng = random.Random(n * m)
    pairs = {(f"n{rng.randrange(n):02}", f"n{rng.randrange(n):02}") for _ in range(m)}
    df = spark.createDataFrame([*pairs, (None, "n00"), ("n01", None)], "a string, b string")
    got = {r.node: r.component for r in G.strong_components(df).collect()}
    assert got == components(pairs)


def test_no_components(spark):
    df = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(5)], "a string, b string")
    assert G.strong_components(df).count() == 0
    assert G.strong_components(df.limit(0)).columns == ["node", "component"]


def test_what_hangs_on_a_cycle_is_on_none(spark):
    """Before, behind and between two cycles; a directory that names itself; one name in two graphs."""
    pairs = [("a", "b"), ("b", "a"), ("b", "m"), ("m", "x"), ("x", "y"), ("y", "x"), ("in", "a"), ("y", "out"), ("s", "s")]
    edges = spark.createDataFrame([("g", a, b) for a, b in pairs] + [("h", "a", "b")], "graph_id string, cfg_path string, dep_path string")
    got = {(r.graph_id, r.cfg_path): r.cycle for r in G.cycle_members(edges).collect()}
    assert got == {("g", "a"): "b", ("g", "b"): "b", ("g", "x"): "y", ("g", "y"): "y", ("g", "s"): "s"}
    assert {r.cfg_path for r in G.cyclic_dirs(edges).collect()} == set("abxys")


def random_runs(make_runs, seed, n=40):
    rng = random.Random(seed)
    dirs = [f"d{i}" for i in range(n)]
    rows = []
    for i, d in enumerate(dirs):
        # Mostly earlier directories, some later ones, which close cycles.
        deps = {rng.choice(dirs[: i + 1] if rng.random() < 0.85 else dirs) for _ in range(rng.randrange(3))}
        status = rng.choices(["waiting", "succeeded", "running", "failed"], [14, 2, 1, 1])[0]
        accounts = ["a1"] if rng.random() < 0.1 else []
        rows.append(dict(execution_id=f"r{i}", commit_id="c", cfg_path=d, cfg_deps=sorted(deps), status=status, account_name=f"a{i % 5}", account_deps=accounts))
    return rows, make_runs(*rows)


def plain_waves(rows):
    """Wave of each waiting run, by trying all pending ones again and again."""
    pending, waves, number = {r["execution_id"]: r for r in rows if r["status"] != "succeeded"}, {}, 0
    while True:
        number += 1
        dirs, accounts = {r["cfg_path"] for r in pending.values()}, {r["account_name"] for r in pending.values()}
        ready = [i for i, r in pending.items() if r["status"] == "waiting" and not dirs & set(r["cfg_deps"]) and not accounts & set(r["account_deps"])]
        leave = ready + [i for i, r in pending.items() if number == 1 and r["status"] == "running"]
        if not leave:
            return waves | {i: None for i, r in pending.items() if r["status"] == "waiting"}
        waves |= dict.fromkeys(ready, number)
        for i in leave:
            del pending[i]


@pytest.mark.parametrize("seed", [1, 2])
def test_waves_and_reasons(spark, make_runs, seed):
    rows, runs = random_runs(make_runs, seed)
    waves = plain_waves(rows)
    assert {r.execution_id: r.wave for r in G.deploy_waves(runs).collect()} == waves
    by_id = {r["execution_id"]: r for r in rows if r["status"] != "succeeded"}
    waits = {
        (i, j)
        for i, r in by_id.items()
        for j, p in by_id.items()
        if r["status"] == "waiting" and (p["cfg_path"] in r["cfg_deps"] or p["account_name"] in r["account_deps"])
    }
    out = successors(waits)
    after = {i: closure(out, out.get(i, ())) for i in by_id}
    cycle = components(waits)
    expected = {
        i: (
            i in cycle,
            any(j in cycle and cycle[j] != cycle.get(i) for j in after[i]),
            any(by_id[j]["status"] == "failed" for j in after[i]),
            False,
        )
        for i, wave in waves.items()
        if wave is None
    }
    got = G.blocked_reasons(runs)
    assert {r.execution_id: tuple(r)[2:] for r in got.collect()} == expected


def test_unknown_lists_block(spark, make_runs):
    a = dict(execution_id="a", commit_id="c", cfg_path="a", cfg_deps=None)
    b = dict(execution_id="b", commit_id="c", cfg_path="b", cfg_deps=["a"])
    got = {r.execution_id: r.unknown for r in G.blocked_reasons(make_runs(a, b)).collect()}
    assert got == {"a": True, "b": True}
    assert G.blocked_reasons(make_runs()).count() == 0


def test_what_was_seen_is_not_moved(spark):
    """The plan of a round has one exchange, of what the round has found."""
    pairs = spark.range(400).selectExpr("id % 7 as g", "id as k")
    seen = Grown(fold=3)
    for part in range(7):
        seen.add(dealt(pairs.where(f"g = {part}"), ["g", "k"]))
    found = unseen(pairs.union(pairs), seen.frame, ["g", "k"])
    plan = found._jdf.queryExecution().sparkPlan().toString()
    executed = found._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") == 1, executed
    assert "ExistingRDD" in plan and found.count() == 0
    more = unseen(spark.range(390, 410).selectExpr("id % 7 as g", "id as k"), seen.frame, ["g", "k"])
    assert sorted(r.k for r in more.collect()) == list(range(400, 410))


def test_a_long_chain_moves_each_row_once(spark, make_runs, monkeypatch):
    """Rows stored over all rounds grow with the chain's length, not with its square."""
    stored = []
    cut = placed.cut
    monkeypatch.setattr(placed, "cut", lambda df: stored.append(cut(df)) or stored[-1])

    def rows_stored(levels):
        stored.clear()
        runs = make_runs(*[dict(execution_id=f"r{i:03}", commit_id="c", cfg_path=f"d{i}", cfg_deps=[f"d{i - 1}"] if i else [], account_name=f"a{i}") for i in range(levels)])
        waves = {r.execution_id: r.wave for r in G.deploy_waves(runs).collect()}
        assert waves == {f"r{i:03}": i + 1 for i in range(levels)}
        return sum(df.count() for df in stored)

    # Three times the rows, one more copy of those that are folded.
    short, long = rows_stored(7), rows_stored(21)
    assert long <= 4 * short


def test_closure_of_a_chain_stores_each_row_once(spark, monkeypatch):
    stored = []
    cut = placed.cut
    monkeypatch.setattr(placed, "cut", lambda df: stored.append(cut(df)) or stored[-1])
    n = 30
    nodes = spark.createDataFrame([("g", f"d{i}") for i in range(n)], "graph_id string, cfg_path string")
    edges = spark.createDataFrame([("g", f"d{i + 1}", f"d{i}") for i in range(n - 1)], "graph_id string, cfg_path string, dep_path string")
    seeds = spark.createDataFrame([("c", "g", "d0"), ("c2", "g", "d5")], "commit_id string, graph_id string, dir string")
    found = G.impact_closure(nodes, edges, seeds)
    assert found.count() == 2 * n - 5
    # Edges once for every salt, each row found once, and once more when sixteen rounds are folded.
    assert sum(df.count() for df in stored) <= placed.SALTS * (n - 1) + 3 * (2 * n - 5)
    with pytest.raises(RuntimeError):
        G.impact_closure(nodes, edges, seeds, max_rounds=10)


def test_ready_runs_follow_the_events(spark, make_runs, tmp_path):
    """After each batch of random events the kept counts give the frontier of the whole table."""
    rng = random.Random(9)
    rows = []
    for commit in "cde":
        more, _ = random_runs(make_runs, ord(commit), 16)
        rows += [{**r, "commit_id": commit, "execution_id": commit + r["execution_id"]} for r in more]
    table = {r["execution_id"]: dict(r) for r in rows}
    live = ReadyRuns(spark, f"{tmp_path}/ready", buckets=8)
    live.create(make_runs(*table.values()))
    ready = {r.execution_id for r in live.ready().collect()}
    for batch in range(6):
        frontier = {r.execution_id for r in G.ready_frontier(make_runs(*table.values())).collect()}
        assert {r.execution_id for r in live.ready().collect()} == frontier
        events = []
        for run in rng.sample(sorted(frontier), min(len(frontier), 3)):
            events.append((table[run]["commit_id"], run, rng.choice(["succeeded", "succeeded", "running", "failed"])))
        running = [i for i, r in table.items() if r["status"] == "running"]
        events += [(table[i]["commit_id"], i, "succeeded") for i in rng.sample(running, min(len(running), 1))]
        for _, run, status in events:
            table[run]["status"] = status
        df = spark.createDataFrame(events + events[:1], "commit_id string, execution_id string, status string")
        new = {r.execution_id for r in live.apply(batch, df).collect()}
        # The same batch once more changes nothing, nor do its events in a later one.
        assert {r.execution_id for r in live.apply(batch, df).collect()} == new
        now = {r.execution_id for r in live.ready().collect()}
        assert new == now - ready
        ready = now
    assert ready == {r.execution_id for r in G.ready_frontier(make_runs(*table.values())).collect()}


def test_events_read_their_commits_alone(spark, make_runs, tmp_path):
    rows = [dict(execution_id=f"r{i}", commit_id=f"c{i}", cfg_path="d", cfg_deps=[]) for i in range(40)]
    live = ReadyRuns(spark, f"{tmp_path}/ready", buckets=16)
    live.create(make_runs(*rows))
    df = spark.createDataFrame([("c7", "r7", "succeeded")], "commit_id string, execution_id string, status string")
    found = live.tables["gates"].found_by(0, df)
    assert 0 < found.count() <= 40 and found.select(live.tables["gates"].bucket()).distinct().count() == 1
