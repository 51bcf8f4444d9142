"""Ready frontier, waves, rollback: fixed cases and invariants."""

import json

import pytest
from pyspark.sql import functions as F

from cascadia.functions.lists import PAGE_ROWS
from cascadia.operators.graph import (
    cyclic_dirs,
    deploy_stack,
    deploy_waves,
    diff_paths,
    impact_closure,
    ready_frontier,
    rollback_stack,
)
from cascadia.operators.lifecycle import (
    advance,
    failure_cascade,
    merge_lock,
    rollback_on_failure,
    run_status_apply,
    start_ready,
)
from cascadia.plans import frames
from cascadia.plans.views import Tables
from tests.conftest import SMALL


def ids(df):
    return sorted(r.execution_id for r in df.collect())


def run(execution_id, cfg_path, cfg_deps=(), status="waiting", **more):
    return dict(
        execution_id=execution_id,
        cfg_path=cfg_path,
        cfg_deps=None if cfg_deps is None else list(cfg_deps),
        status=status,
        **more,
    )


FRONTIER_CASES = {
    "alone": ([run("quay", "port/quay"), run("lock", "port/lock")], ["lock", "quay"]),
    "one of two parents open": (
        [
            run("pump", "mill/pump", status="succeeded"),
            run("sluice", "mill/sluice", status="running"),
            run("wheel", "mill/wheel", ["mill/pump", "mill/sluice"]),
            run("belt", "mill/belt", ["mill/pump"]),
        ],
        ["belt"],
    ),
    "behind a broken one": (
        [
            run("kiln", "clay/kiln", status="aborted"),
            run("glaze", "clay/glaze", ["clay/kiln"]),
            run("shelf", "clay/shelf", ["clay/glaze"]),
            run("cart", "clay/cart", ["clay/none"]),
        ],
        ["cart"],
    ),
    "accounts in a row": (
        [
            run("well", "spring/well", account_name="spring"),
            run("pipe", "brook/pipe", account_name="brook", account_deps=["spring"]),
            run("tap", "river/tap", account_name="river", account_deps=["brook", "delta"]),
        ],
        ["well"],
    ),
    "self dep": ([run("ring", "hall/ring", ["hall/ring"])], []),
    "null list": ([run("bell", "hall/bell", None)], []),
    "null element": ([run("rope", "hall/rope", [None])], ["rope"]),
    "other commit": (
        [
            run("mast", "ship/mast", commit_id="c1", status="failed"),
            run("sail", "ship/sail", ["ship/mast"], commit_id="c2"),
        ],
        ["sail"],
    ),
}


@pytest.mark.parametrize("name", FRONTIER_CASES)
def test_frontier(make_runs, name):
    rows, expected = FRONTIER_CASES[name]
    assert ids(ready_frontier(make_runs(*rows))) == expected


def test_frontier_strict(make_runs):
    one = make_runs(run("r-first", "live/app"), run("r-second", "live/net", status="running"))
    assert ids(ready_frontier(one, strict=True)) == ["r-first"]
    two = make_runs(run("r-first", "a", commit_id="c1"), run("r-second", "b", commit_id="c2"))
    with pytest.raises(Exception, match="(?i)subquery"):
        ready_frontier(two, strict=True).collect()


def test_frontier_with_long_lists(spark, make_runs):
    runs = make_runs(
        run("run-a", "a", None),
        run("run-b", "b", None),
        run("run-c", "c", status="running"),
        run("run-d", "d", None),
    )
    deps = spark.createDataFrame([("run-a", "x"), ("run-b", "c")], "execution_id string, dep_path string")
    assert ids(ready_frontier(runs, deps=deps)) == ["run-a"]
    waves = {r.execution_id: r.wave for r in deploy_waves(runs, deps=deps).collect()}
    assert waves == {"run-a": 1, "run-b": 2, "run-d": None}


def test_rollback_order_with_long_lists(spark, make_runs):
    """What a long list says is reversed like what a row says."""

    def rows(listed):
        deps = ["base"] if listed else None
        return make_runs(
            run("up", "base", status="succeeded", new_resources=["r.a"]),
            run("top", "top", deps, status="succeeded", new_resources=["r.b"]),
            run("bad", "bad", status="running", new_resources=["r.c"]),
        )

    finished = spark.createDataFrame(
        [(1, 1, "bad", "failed", False, "c0ffee")],
        "event_id int, ts int, execution_id string, status string, is_rollback boolean, commit_id string",
    )
    known = spark.createDataFrame([("top", "base")], "execution_id string, dep_path string")

    def after(runs, known=None):
        return {r.cfg_path: r.status for r in advance(runs, finished, known).runs.filter("is_rollback").collect()}

    expected = {"base": "waiting", "top": "running", "bad": "running"}
    assert after(rows(True)) == expected
    assert after(rows(False), known) == expected


def test_unread_events_change_nothing(spark, make_runs):
    runs = make_runs(run("a", "a", status="running", new_resources=["r.a"]))
    finished = spark.createDataFrame(
        [(1, 1, "a", "failed", None, "c0ffee", "missing: is_rollback")],
        "event_id int, ts int, execution_id string, status string, is_rollback boolean, commit_id string, error string",
    )
    done = advance(runs, finished)
    assert [(r.execution_id, r.status) for r in done.runs.collect()] == [("a", "running")]
    assert [r.error for r in done.errors.collect()] == ["missing: is_rollback"]


def test_inputs_hold_long_lists(spark, make_runs):
    runs = make_runs(run("a", "a", None), run("b", "b", ["x"]))
    deps = spark.createDataFrame([("a", "z"), ("a", "y")], "execution_id string, dep_path string")
    inputs = {r.execution_id: json.loads(r.input_json)["cfg_deps"] for r in start_ready(runs, deps=deps).inputs.collect()}
    assert inputs == {"a": ["y", "z"], "b": ["x"]}


def test_waves(make_runs):
    runs = make_runs(
        run("a", "a"),
        run("b", "b", ["a"]),
        run("c", "c", ["a", "b"]),
        run("loop", "loop", ["loop"]),
        run("behind", "behind", ["broken"]),
        run("broken", "broken", status="aborted"),
        run("busy", "busy", status="running"),
        run("after", "after", ["busy"]),
        run("acc", "acc", account_name="prod", account_deps=["dev2"]),
        run("dev2", "dev2", ["a"], account_name="dev2"),
    )
    waves = {r.execution_id: (r.wave, r.blocked) for r in deploy_waves(runs).collect()}
    assert waves == {
        "a": (1, False),
        "b": (2, False),
        "c": (3, False),
        "loop": (None, True),
        "behind": (None, True),
        "after": (2, False),
        "dev2": (2, False),
        "acc": (3, False),
    }


def test_waves_start_with_the_frontier_and_grow_along_edges(spark):
    runs = frames.runs(Tables(spark, SMALL))
    waves = deploy_waves(runs).cache()
    assert ids(waves.filter("wave = 1")) == ids(ready_frontier(runs))
    own = runs.join(waves.select("execution_id", "wave"), "execution_id").select(
        "commit_id", "cfg_path", "cfg_deps", "wave"
    )
    edges = own.select("commit_id", F.explode("cfg_deps").alias("dep"), "wave").join(
        own.select("commit_id", F.col("cfg_path").alias("dep"), F.col("wave").alias("w")),
        ["commit_id", "dep"],
    )
    assert edges.filter("wave <= w").count() == 0


def test_max_rounds(make_runs):
    runs = make_runs(run("a", "a"), run("b", "b", ["a"]), run("c", "c", ["b"]))
    with pytest.raises(RuntimeError):
        deploy_waves(runs, max_rounds=2)
    assert deploy_waves(runs, max_rounds=3).filter("blocked").count() == 0


def graph(spark, edges, extra=()):
    dirs = {d for e in edges for d in e} | set(extra)
    nodes = spark.createDataFrame([("g", d) for d in dirs], "graph_id string, cfg_path string")
    rows = [("g", c, d, i) for i, (c, d) in enumerate(edges)]
    return nodes, spark.createDataFrame(
        rows, "graph_id string, cfg_path string, dep_path string, pos int"
    )


def closure(spark, nodes, edges, dirs):
    seeds = spark.createDataFrame(
        [("c", "g", d) for d in dirs], "commit_id string, graph_id string, dir string"
    )
    return sorted(r.cfg_path for r in impact_closure(nodes, edges, seeds).collect())


#: What runs on what in a small service: two ways from the reports to the disk, one to the queue.
SERVICE = [
    ("web", "api"), ("api", "db"), ("api", "queue"), ("jobs", "queue"), ("jobs", "db"), ("report", "jobs"), ("db", "disk"),
]


def test_closure_reaches_all(spark):
    nodes, edges = graph(spark, SERVICE)
    assert closure(spark, nodes, edges, ["disk"]) == ["api", "db", "disk", "jobs", "report", "web"]
    assert closure(spark, nodes, edges, ["queue", "web"]) == ["api", "jobs", "queue", "report", "web"]
    assert closure(spark, nodes, edges, ["report"]) == ["report"]


def test_closure_ends_on_a_cycle(spark):
    nodes, edges = graph(spark, [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("b", "e")])
    assert closure(spark, nodes, edges, ["e"]) == ["a", "b", "c", "d", "e"]
    assert sorted(r.cfg_path for r in cyclic_dirs(edges).collect()) == ["a", "b", "c"]
    assert cyclic_dirs(edges.filter("cfg_path <> 'c'")).count() == 0


def test_closure_of_a_dir_outside_the_graph(spark):
    nodes, edges = graph(spark, [("a", "ghost"), ("b", "a")])
    known = nodes.filter("cfg_path <> 'ghost'")
    assert closure(spark, known, edges, ["ghost"]) == ["a", "b"]


def test_closure_is_idempotent(spark):
    nodes, edges = graph(spark, SERVICE)
    once = closure(spark, nodes, edges, ["jobs"])
    assert closure(spark, nodes, edges, once) == once


def test_unknown_scan_type():
    with pytest.raises(ValueError):
        diff_paths("guess")


def test_deploy_stack_lists_only_changed_dependencies(spark):
    nodes, edges = graph(spark, SERVICE)
    diff = spark.createDataFrame(
        [("commit", "g", d) for d in ("report", "jobs", "db", "web")],
        "commit_id string, graph_id string, cfg_path string",
    )
    providers = spark.createDataFrame(
        [("g", "jobs", ["p1"])], "graph_id string, cfg_path string, new_providers array<string>"
    )
    dim = spark.createDataFrame(
        [("g", "live/g", [], 1, 1, ["v"], "pa", "aa")],
        "account_name string, account_path string, account_deps array<string>, min_approval_count int,"
        "min_rejection_count int, voters array<string>, plan_role_arn string, apply_role_arn string",
    )
    commits = spark.createDataFrame(
        [("commit", 3, "trunk", "f")], "commit_id string, pr_id int, base_ref string, head_ref string"
    )
    stack = deploy_stack(nodes, edges, diff, providers, dim, commits)
    rows = {r.cfg_path: r for r in stack.table().collect()}
    assert {k: r.cfg_deps for k, r in rows.items()} == {"report": ["jobs"], "jobs": ["db"], "db": [], "web": []}
    assert {k for k, r in rows.items() if r.new_providers == ["p1"]} == {"jobs"}
    start = "run-3-comm-g-report-"
    assert rows["report"].execution_id.startswith(start) and len(rows["report"].execution_id) == len(start) + 12
    assert rows["web"].plan_command == (
        "terragrunt plan --terragrunt-working-dir web --terragrunt-iam-role pa -no-color"
    )
    # A list over the limit is NULL in the row and whole in long form.
    assert {r.cfg_path for r in stack.table(limit=0).filter("cfg_deps is null").collect()} == {"jobs", "report"}
    assert stack.long_deps(limit=0).count() == 2
    assert stack.long_deps().count() == 0


def failing(spark, *rows):
    return spark.createDataFrame(
        rows or [("e1", 1, "r-first", "failed", False, "c0ffee")],
        "event_id string, ts int, execution_id string, status string, is_rollback boolean, commit_id string",
    )


def test_status_update_takes_the_last_event(spark, make_runs):
    events = failing(
        spark,
        ("e1", 2, "r-first", "succeeded", False, "c0ffee"),
        ("e2", 1, "r-first", "failed", False, "c0ffee"),
    )
    runs = make_runs(run("r-first", "a", status="running"), run("r-second", "b"))
    after = {r.execution_id: r.status for r in run_status_apply(runs, events).collect()}
    assert after == {"r-first": "succeeded", "r-second": "waiting"}


def test_cascade(spark, make_runs):
    runs = make_runs(
        run("r-first", "a", status="failed"),
        run("r-second", "b"),
        run("r-third", "c", status="running"),
        run("run-done", "d", status="succeeded"),
        run("run-back", "e", is_rollback=True),
        run("run-else", "f", commit_id="other"),
    )
    after = failure_cascade(runs, failing(spark))
    assert {r.execution_id: r.status for r in after.runs.collect()} == {
        "r-first": "failed",
        "r-second": "aborted",
        "r-third": "aborted",
        "run-done": "succeeded",
        "run-back": "waiting",
        "run-else": "waiting",
    }
    assert after.errors.count() == 0
    back = failing(spark, ("e1", 1, "run-back", "failed", True, "c0ffee"))
    after = failure_cascade(runs, back)
    assert ids(after.errors) == ["run-back"]
    assert ids(after.runs.filter("status = 'aborted'")) == []


def test_rollback(spark, make_runs):
    runs = make_runs(
        run("r-first", "live/app", ["live/net"], "failed", new_resources=[]),
        run("r-second", "live/net", [], "succeeded", new_resources=["a.x", "b.y"]),
        run("r-third", "live/dns", ["live/net"], "succeeded", new_resources=["c.z"]),
    )
    rows = {r.cfg_path: r for r in rollback_stack(runs, runs.filter("status = 'failed'")).table().collect()}
    assert set(rows) == {"live/net", "live/dns"}
    assert rows["live/net"].cfg_deps == ["live/dns"] and rows["live/dns"].cfg_deps == []
    assert rows["live/net"].plan_command == (
        "terragrunt plan --terragrunt-working-dir live/net --terragrunt-iam-role plan-arn"
        " -target a.x -target b.y -no-color -destroy"
    )
    assert rows["live/net"].apply_command == (
        "terragrunt destroy --terragrunt-working-dir live/net --terragrunt-iam-role apply-arn"
        " -target a.x -target b.y -no-color -auto-approve"
    )
    assert rows["live/net"].is_rollback and rows["live/net"].status == "waiting"


def test_rollback_only_once(spark, make_runs):
    runs = make_runs(
        run("r-first", "a", [], "failed", new_resources=["r.r"]),
        run("old", "a", [], "succeeded", is_rollback=True, new_resources=["r.r"]),
    )
    assert rollback_on_failure(runs, failing(spark)).runs.count() == 2


def test_start_ready(make_runs):
    runs = make_runs(run("r-first", "a"), run("r-second", "b", ["a"]))
    started = start_ready(runs)
    row = started.inputs.collect()[0]
    assert row.execution_id == "r-first" and '"status":"running"' in row.input_json
    assert '"plan_command":null' in row.input_json
    assert {r.execution_id: r.status for r in started.runs.collect()} == {
        "r-first": "running",
        "r-second": "waiting",
    }


@pytest.mark.parametrize(
    "state,statuses,lock",
    [
        ("succeeded", ["succeeded", "failed"], "none"),
        ("succeeded", ["succeeded", "running"], "7"),
        ("started", [], "7"),
        ("failed", ["running"], "none"),
    ],
)
def test_lock(spark, state, statuses, lock):
    builds = spark.createDataFrame(
        [("r", 3, 1, "succeeded"), ("r", 7, 2, state)], "repo string, pr_id int, ts int, state string"
    )
    runs = spark.createDataFrame([("r", s) for s in statuses], "repo string, status string")
    assert [r.lock_value for r in merge_lock(runs, builds).collect()] == [lock]


def test_any_number_of_dependents(spark, make_runs):
    n = PAGE_ROWS + 1
    dependents = [run(f"run-{i}", f"d{i:05d}", ["base"], "failed" if i == 0 else "succeeded", new_resources=["a.x"]) for i in range(n)]
    runs = make_runs(run("run-base", "base", [], "succeeded", new_resources=["b.y"]), *dependents)
    paths = [f"d{i:05d}" for i in range(n)]
    row = rollback_stack(runs, runs.filter("status = 'failed'")).table().filter("cfg_path = 'base'").first()
    assert sorted(row.cfg_deps) == paths
    after = rollback_on_failure(runs, failing(spark, ("e1", 1, "run-0", "failed", False, "c0ffee"))).runs
    assert [sorted(r.cfg_deps) for r in after.filter("is_rollback AND cfg_path = 'base'").collect()] == [paths]


def test_any_number_of_dependencies(spark):
    n = PAGE_ROWS + 1
    dirs = spark.range(n).selectExpr("'g' AS graph_id", "format_string('d%05d', id) AS cfg_path", "cast(id AS int) AS pos")
    top = spark.createDataFrame([("g", "top")], "graph_id string, cfg_path string")
    nodes = dirs.select("graph_id", "cfg_path").unionByName(top)
    edges = dirs.selectExpr("graph_id", "'top' AS cfg_path", "cfg_path AS dep_path", "pos")
    diff = nodes.selectExpr("'commit' AS commit_id", "graph_id", "cfg_path")
    providers = spark.createDataFrame([], "graph_id string, cfg_path string, new_providers array<string>")
    dim = spark.createDataFrame(
        [("g", "live/g", [], 1, 1, ["v"], "pa", "aa")],
        "account_name string, account_path string, account_deps array<string>, min_approval_count int,"
        "min_rejection_count int, voters array<string>, plan_role_arn string, apply_role_arn string",
    )
    commits = spark.createDataFrame([("commit", 3, "trunk", "f")], "commit_id string, pr_id int, base_ref string, head_ref string")
    rows = deploy_stack(nodes, edges, diff, providers, dim, commits).table()
    assert rows.filter("cfg_path = 'top'").first().cfg_deps == [f"d{i:05d}" for i in range(n)]
