"""Votes against a one-by-one fold, with and without hot-group slicing."""

import random

import pytest

from cascadia.functions.lists import PAGE_ROWS
from cascadia.functions.ordered import numbered, previous_value, running_sums
from cascadia.operators.votes import late_votes, vote_decision, voter_union

RUNS = (
    "execution_id string, approval_voters array<string>, rejection_voters array<string>, "
    "min_approval_count int, min_rejection_count int"
)
VOTES = "vote_id bigint, ts int, execution_id string, voter string, action string"


def fold(runs, votes):
    """Decisions, acceptance per vote and final lists, one vote at a time."""
    lists = {r[0]: (set(r[1]), set(r[2])) for r in runs}
    minima = {r[0]: r[3:] for r in runs}
    decided, accepted = {}, {}
    for vote_id, _, run, voter, action in sorted(votes, key=lambda v: (v[1], v[0])):
        accepted[vote_id] = run not in decided
        yes, no = lists[run]
        joins, leaves = (yes, no) if action == "approve" else (no, yes)
        joins.add(voter)
        leaves.discard(voter)
        if run not in decided and (len(yes) == minima[run][0] or len(no) == minima[run][1]):
            decided[run] = (vote_id, action, len(yes), len(no))
    return decided, accepted, {k: (sorted(a), sorted(b)) for k, (a, b) in lists.items()}


def sample(seed, n_votes=400, n_runs=12):
    rng = random.Random(seed)
    names = [f"v{i}" for i in range(6)]
    runs = [
        (f"run-{i}", rng.sample(names, rng.randint(0, 2)), rng.sample(names, rng.randint(0, 2)),
         rng.randint(0, 5), rng.randint(0, 5))
        for i in range(n_runs)
    ]
    # A third of the votes are on one run.
    votes = [
        (i, rng.randint(0, 60), f"run-{0 if rng.random() < 0.34 else rng.randrange(n_runs)}",
         rng.choice(names), rng.choice(["approve", "reject"]))
        for i in range(n_votes)
    ]
    return runs, votes


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_like_a_fold(spark, seed):
    runs, votes = sample(seed)
    decided, accepted, lists = fold(runs, votes)
    run_df, vote_df = spark.createDataFrame(runs, RUNS), spark.createDataFrame(votes, VOTES)
    found = vote_decision(run_df, vote_df).collect()
    assert {r.execution_id: (r.vote_id, r.action, r.n_approve, r.n_reject) for r in found} == decided
    late = late_votes(run_df, vote_df).collect()
    assert {r.vote_id: r.accepted for r in late} == accepted
    after = voter_union(run_df, vote_df).collect()
    assert {
        r.execution_id: (sorted(r.approval_voters), sorted(r.rejection_voters)) for r in after
    } == lists


def case(spark, minima, *votes, approved=(), rejected=()):
    runs = spark.createDataFrame([("r", list(approved), list(rejected), *minima)], RUNS)
    rows = [(i, i, "r", v, a) for i, (v, a) in enumerate(votes)]
    return [(r.vote_id, r.action) for r in vote_decision(runs, spark.createDataFrame(rows, VOTES)).collect()]


def test_fixed_cases(spark):
    assert case(spark, (2, 2), ("a", "approve"), ("b", "approve")) == [(1, "approve")]
    assert case(spark, (2, 2), ("a", "approve")) == []
    assert case(spark, (2, 2), ("a", "approve"), ("a", "approve")) == []
    assert case(spark, (2, 1), ("a", "approve"), ("a", "reject")) == [(1, "reject")]
    # A minimum of 0 on the other side: the first vote decides.
    assert case(spark, (0, 3), ("a", "reject")) == [(0, "reject")]
    # Equality, not at least: a list that starts above its minimum does not decide.
    assert case(spark, (1, 5), ("c", "approve"), approved=["a", "b"]) == []


def test_null_list_counts_as_empty_when_joined(spark):
    runs = spark.createDataFrame([("r", None, [], 1, 1)], RUNS)
    votes = spark.createDataFrame([(1, 1, "r", "a", "approve")], VOTES)
    assert voter_union(runs, votes).collect()[0].approval_voters == ["a"]


def test_any_number_of_voters(spark):
    n = PAGE_ROWS + 1
    runs = spark.createDataFrame([("r", ["v00000", "x"], ["y"], 1, 1), ("s", [], ["v00001"], 1, 1)], RUNS)
    votes = spark.range(n).selectExpr("id AS vote_id", "1 AS ts", "'r' AS execution_id", "format_string('v%05d', id) AS voter", "'approve' AS action")
    votes = votes.unionByName(votes.selectExpr("vote_id + 100000 AS vote_id", "ts", "'s' AS execution_id", "voter", "'reject' AS action"))
    after = {r.execution_id: (r.approval_voters, r.rejection_voters) for r in voter_union(runs, votes).collect()}
    voters = [f"v{i:05d}" for i in range(n)]
    assert after == {"r": ([*voters, "x"], ["y"]), "s": ([], voters)}


@pytest.mark.parametrize("sliced", [False, True])
def test_ordered_helpers(spark, sliced):
    rng = random.Random(7)
    rows = [(rng.choice("aaab"), i, rng.randint(-3, 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, i int, x int")
    before, total, expected = {}, {}, {}
    for k, i, x in rows:
        total[k] = total.get(k, 0) + x
        expected[i] = (before.get(k), total[k])
        before[k] = x
    lagged = previous_value(df, ["k"], ["i"], "x", "p", sliced)
    summed = running_sums(lagged, ["k"], ["i"], {"x": "s"}, sliced)
    assert {r.i: (r.p, r.s) for r in summed.collect()} == expected


def test_numbered(spark):
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 as k")
    assert all(r.n == r.k + 1 for r in numbered(df, ["k"], "n").collect())
