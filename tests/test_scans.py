"""Scans, text expressions and small operators on fixed cases."""

import hashlib
import hmac
import json
import random
import re
import urllib.parse

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cascadia.functions import text as X
from cascadia.functions.lists import inline_lists, ordered_pages, paged_list
from cascadia.operators import aggregates as A
from cascadia.operators import filters as FL
from cascadia.operators import joins as J
from cascadia.operators.lifecycle import step_outcome, webhook_jobs
from cascadia.sources import events as E
from cascadia.sources import logs as S
from cascadia.sources import tables as D

SECRET = "s3cret"


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values))
    return df.select(column).collect()[0][0]


WORDS = ["a b", "x*y~z", "50%+é/", "a=b&c", "plain", "voter-1@x.com"]


@pytest.mark.parametrize("word", WORDS)
def test_link_coding(spark, word):
    once = urllib.parse.quote_plus(word).replace("+", " ")
    expected = urllib.parse.quote_plus(once).replace("%", "$")
    assert one(spark, X.link_encode(F.col("w")), w=word) == expected
    assert one(spark, X.link_decode(F.col("w")), w=expected) == word


@pytest.mark.parametrize("secret", ["k", "x" * 64, "y" * 65])
def test_hmac(spark, secret):
    expected = hmac.new(secret.encode(), "mé".encode(), hashlib.sha256).hexdigest()
    assert one(spark, X.hmac_sha256(secret, F.col("m")), m="mé") == expected


def test_text_helpers(spark):
    assert one(spark, X.dirname(F.col("p")), p="a/b/c.tf") == "a/b"
    assert one(spark, X.dirname(F.col("p")), p="c.tf") == ""
    assert one(spark, X.leaf(F.col("p")), p="a/b/c") == "c"
    assert one(spark, X.csv_list(F.col("p")), p="") == []
    assert one(spark, X.csv_list(F.col("p")), p="a,b") == ["a", "b"]
    assert one(spark, X.brace_list(F.col("p")), p="{}") == []
    assert one(spark, X.brace_list(F.col("p")), p="{a,b}") == ["a", "b"]
    assert one(spark, X.target_flags(F.col("p")), p=["a.b", "c"]) == " -target a.b -target c"
    for path, expected in (("/r/a/b", "a/b"), ("/r", "."), ("/other/a", "/other/a")):
        assert one(spark, X.relative_to(F.col("p"), F.col("r")), p=path, r="/r") == expected


def ids_of(df):
    return sorted(r.execution_id for r in df.collect())


PLAN = """
Harbour cranes:
  + crane_north = 4
  + crane_west  = 1
  ~ crane_east  = 2 -> 3
 - crane_old = 9
nothing else moves
    -deep = true
"""

BLOCK = """
``` diff

Harbour cranes:
+   crane_north = 4
+   crane_west  = 1
!   crane_east  = 2 -> 3
-  crane_old = 9
nothing else moves
-    deep = true

```
"""


def test_plan_text(spark):
    plans = spark.createDataFrame([("run-1", PLAN)], "execution_id string, text string")
    row = FL.plan_change_summary(plans).collect()[0]
    assert row.diff == BLOCK
    assert (row.n_add, row.n_change, row.n_destroy) == (2, 1, 2)


def test_plan_text_like_a_line_scan(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice(" \n\t+-~ab") for _ in range(40)) for _ in range(400)]

    def marked(match):
        found = match.group(0)
        sign = found[-1]
        blank = found[:-1] + " "
        return blank.replace(" ", "!" if sign == "~" else sign, 1)

    expected = [re.sub(r"^\s*[+\-~]", marked, t, flags=re.MULTILINE) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.d for r in df.select("i", FL.diff_text(F.col("t")).alias("d")).collect()}
    assert [got[i] for i in range(len(texts))] == expected


def signed(body, secret=SECRET, prefix="sha256="):
    return prefix + hmac.new(secret.encode(), body.encode(), hashlib.sha256).hexdigest()


def event(action="opened", merged=False, number=1, kind="pull_request", body=None, sig=None, repo="org/repo", **more):
    doc = {
        "action": action,
        "repository": {"full_name": repo, "id": 3},
        "pull_request": {
            "merged": merged,
            "number": number,
            "base": {"sha": "b", "ref": "master"},
            "head": {"sha": "h", "ref": "feature"},
            **more,
        },
    }
    body = json.dumps(doc) if body is None else body
    return (kind, signed(body) if sig is None else sig, body)


RAW = "event_id bigint, ts int, headers struct<`x-github-event`:string,`x-hub-signature-256`:string>, body string"


def raw_events(spark, *events):
    return spark.createDataFrame([(i, i, (k, s), b) for i, (k, s, b) in enumerate(events)], RAW)


def pr_files(spark, *rows, repo="org/repo"):
    return spark.createDataFrame([(repo, *r) for r in rows], "repo string, pr_id bigint, filename string, status string")


def accounts(spark, *rows):
    return spark.createDataFrame(
        rows, "account_name string, account_path string, plan_role_arn string"
    )


def test_webhook_outcomes(spark):
    events = [
        (event(), 200, "Request was successful"),
        (event(action="synchronize"), 404, "Not Found"),
        (event(action="closed"), 404, "Not Found"),
        (event(sig="sha1=00"), 403, "Signature is not a valid sha256 value"),
        (event(sig="sha256=00"), 403, "Header signature and expected signature do not match"),
        (event(number=2), 200, "No diff filepath was matched within pattern: .+\\.(hcl|tf)$"),
        (event(kind="push"), 400, "Event is not a pull request"),
        (event(number=None), 400, "missing: number"),
        (event(kind="push", number=2), 200, "No diff filepath was matched within pattern: .+\\.(hcl|tf)$"),
        (event(body="no json"), 500, "body is not a JSON object"),
        (event(action="closed", merged=True), 200, "Request was successful"),
    ]
    raw = raw_events(spark, *[e for e, _, _ in events])
    files = pr_files(spark, (1, "live/dev/a/x.tf", "removed"), (2, "README.md", "added"))
    scanned = FL.signature_check(FL.webhook_route(E.webhook_scan(raw)), SECRET)
    rows = {r.event_id: r for r in FL.webhook_outcome(scanned, files).collect()}
    for i, (_, code, message) in enumerate(events):
        assert (rows[i].status_code, rows[i].message) == (code, message), i


def test_numbers_repeat_across_repositories(spark):
    raw = raw_events(spark, event(), event(repo="org/other"))
    files = pr_files(spark, (1, "live/dev/a/x.tf", "added")).unionByName(
        pr_files(spark, (1, "README.md", "added"), repo="org/other")
    )
    jobs = webhook_jobs(raw, files, accounts(spark, ("dev", "live/dev", "arn")), SECRET)
    assert {r.event_id: r.accepted for r in jobs.outcome.collect()} == {0: True, 1: False}
    assert [(r.event_id, r.repo, r.cfg_path) for r in jobs.plan_jobs.collect()] == [(0, "org/repo", "live/dev/a")]
    gate = {(r.repo, r.pr_id): r.matched for r in FL.pr_path_gate(files).collect()}
    assert gate == {("org/repo", 1): True, ("org/other", 1): False}


def test_webhook_jobs(spark):
    raw = raw_events(spark, event(), event(action="closed", merged=True), event(sig="sha256=0"))
    files = pr_files(
        spark,
        (1, "live/dev/a/x.tf", "added"),
        (1, "live/dev/a/y.tf", "modified"),
        (1, "live/dev/b/terragrunt.hcl", "modified"),
        (1, "live/dev/c/x.tf", "removed"),
        (1, "live/dev/d/readme.md", "added"),
        (1, "live/devil/a/x.tf", "added"),
    )
    dim = accounts(spark, ("dev", "live/dev", "arn"), ("live", "live", "top"))
    jobs = webhook_jobs(raw, files, dim, SECRET)
    plan = sorted((r.event_id, r.account_name, r.cfg_path, r.role_arn, r.context) for r in jobs.plan_jobs.collect())
    assert [p for p in plan if p[1] == "dev"] == [
        (0, "dev", "live/dev/a", "arn", "Plan: live/dev/a"),
        (0, "dev", "live/dev/b", "arn", "Plan: live/dev/b"),
    ]
    # Accounts may nest: the outer one gets its own jobs.
    assert [p[2] for p in plan if p[1] == "live"] == ["live/dev/a", "live/dev/b", "live/devil/a"]
    assert [r.event_id for r in jobs.stack_jobs.collect()] == [1]


def test_run_events(spark):
    run = {"execution_id": "run-1", "is_rollback": False, "commit_id": "c", "cfg_path": "d"}
    raw = spark.createDataFrame(
        [
            ("e1", 1, json.dumps({**run, "status": "failed", "x": [1]}), "{}", "SUCCEEDED"),
            ("e2", 2, None, json.dumps({**run, "status": "running"}), "ABORTED"),
            ("e3", 3, "", json.dumps(run), "ABORTED"),
        ],
        "event_id string, ts int, output string, input string, status string",
    )
    rows = {r.event_id: r for r in E.run_event_scan(raw).collect()}
    assert [rows[e].status for e in ("e1", "e2", "e3")] == ["failed", "aborted", "aborted"]
    assert {r.execution_id for r in rows.values()} == {"run-1"}


def test_new_resources(spark, make_runs):
    doc = json.dumps(
        {
            "resources": [
                {"type": "t", "name": "a", "provider": 'provider["reg/x"]'},
                {"type": "t", "name": "b", "provider": 'provider["reg/y"]'},
                {"type": "u", "name": "c", "provider": 'module.m.provider["reg/x"].w'},
            ]
        }
    )
    runs = make_runs(
        dict(execution_id="r1", new_providers=["reg/x"]),
        dict(execution_id="r2", new_providers=["reg/x"]),
        dict(execution_id="r3", new_providers=["reg/x"], is_rollback=True),
        dict(execution_id="r4"),
    )
    states = spark.createDataFrame(
        [("r1", doc), ("r2", ""), ("r3", doc), ("r4", doc)], "execution_id string, doc string"
    )
    rows = {r.execution_id: r.new_resources for r in S.new_resources(states, runs).collect()}
    assert rows == {"r1": ["t.a", "u.c"], "r2": []}


def test_logs(spark):
    parts = {"web": ["api", "cdn"], "api": ["db"], "cdn": [], "db": []}
    lines = [f'\t"/src/{name}" ;' for name in parts]
    lines += [f'\t"/src/{name}" -> "/src/{dep}";' for name, deps in parts.items() for dep in deps]
    text = "digraph {\n" + "\n".join(lines) + "\n}\n"
    logs = spark.createDataFrame([("g", "/src", text)], "graph_id string, root string, text string")
    nodes, edges = S.dependency_nodes(logs), S.dependency_edges(logs)
    adjacency = {r.cfg_path: r.deps for r in A.adjacency(nodes, edges).collect()}
    assert adjacency == parts
    paged = sorted(tuple(r.deps) for r in A.adjacency(nodes, edges, page_rows=1).collect())
    assert paged == [(), (), ("api",), ("cdn",), ("db",)]

    providers = (
        "Providers required by configuration:\n.\n├── provider[registry/aws] ~> 3.0\n"
        "└── provider[registry/null]\n\nProviders required by state:\n\n    provider[registry/null]\n"
    )
    logs = spark.createDataFrame([("g", "d", providers)], "graph_id string, cfg_path string, text string")
    assert S.new_providers(logs).collect()[0].new_providers == ["registry/aws"]

    plan = "x\nexit status 2\n\n prefix=[/src/a] \nexit status 1\n\n prefix=[/src/b] \nexit status 2\n\n prefix=[/src/c] "
    logs = spark.createDataFrame(
        [("g", "/src", 2, plan), ("h", "/src", 0, ""), ("bad", "/src", 1, plan)],
        "graph_id string, root string, returncode int, text string",
    )
    rows = sorted((r.graph_id, r.cfg_path, r.error) for r in S.plan_diff_dirs(logs).collect() if r.error is None)
    assert rows == [("g", "a", None), ("g", "c", None)]
    assert [r.graph_id for r in S.plan_diff_dirs(logs).filter("error is not null").collect()] == ["bad"]


STEPS = {
    "ok": ("Plan+ Request Approval+approve Approval Results Apply+ Success", "succeeded"),
    "rejected": ("Plan+ Request Approval+reject Approval Results Reject", "failed"),
    "plan": ("Plan- Reject", "failed"),
    "approval": ("Plan+ Request Approval- Reject", "failed"),
    "apply": ("Plan+ Request Approval+approve Approval Results Apply- Reject", "failed"),
    "open": ("Plan+", "running"),
}


def test_step_outcomes(spark):
    states = ("Plan", "Request Approval", "Approval Results", "Apply", "Success", "Reject")
    rows, paths = [], {}
    for run, (path, _) in STEPS.items():
        found = re.findall("(" + "|".join(states) + r")([+-]?)(approve|reject)?", path)
        paths[run] = " > ".join(s for s, _, _ in found)
        for s, mark, answer in found:
            rows.append((run, len(rows), "TaskStateEntered", s, ""))
            if mark:
                kind = "TaskSucceeded" if mark == "+" else "TaskFailed"
                rows.append((run, len(rows), kind, s, f'"{answer}"' if answer else ""))
    random.Random(1).shuffle(rows)
    # Deliveries may repeat.
    events = spark.createDataFrame(
        rows + rows[:5], "execution_id string, id int, type string, state string, output string"
    )
    got = {r.execution_id: (r.path, r.status) for r in step_outcome(events).collect()}
    assert got == {run: (paths[run], status) for run, (_, status) in STEPS.items()}


def test_status_rollup(spark):
    cases = {
        "run": (["succeeded", "running", "odd"], "running", None),
        "odd": (["succeeded", "odd", "running"], None, "status is unknown: odd"),
        "fail": (["succeeded", "failed"], "failed", None),
        "good": (["succeeded"], "succeeded", None),
        "abort": (["aborted", "failed"], None, "status is unknown: aborted"),
        "none": ([None], None, "no status"),
    }
    rows = [(c, i, s) for c, (ss, _, _) in cases.items() for i, s in enumerate(ss)]
    df = spark.createDataFrame(rows, "commit_id string, pos int, status string")
    got = {r.commit_id: (r.status, r.error) for r in A.status_rollup(df).collect()}
    assert got == {c: (s, e) for c, (_, s, e) in cases.items()}


def test_deliveries(spark):
    rows = [("a", "v1", "Success"), ("a", "v2", "Failed"), ("b", "v1", "Success")]
    df = spark.createDataFrame(rows, "execution_id string, voter string, status string")
    got = {r.execution_id: (r.status_code, r.message) for r in A.delivery_failures(df).collect()}
    assert got == {"a": (500, "1/2 emails failed to send"), "b": (200, "All emails were successfully sent")}


def test_upsert(spark):
    names = ["account_name", "account_path", "plan_role_arn", "apply_role_arn"]
    schema = (
        "account_name string, account_path string, account_deps array<string>, min_approval_count int,"
        "min_rejection_count int, voters array<string>, plan_role_arn string, apply_role_arn string"
    )
    dim = spark.createDataFrame([("a", "p", [], 1, 1, ["v"], "x", "y"), ("b", "q", [], 1, 1, [], "x", "y")], schema)
    updates = spark.createDataFrame(
        [("a", "p1", [], 2, 2, [], "x1", "y1", 1), ("a", None, ["c"], 3, 3, None, "x2", None, 2), ("c", "r", [], 0, 0, [], "z", "z", 1)],
        schema + ", seq int",
    )
    got = {r.account_name: r for r in D.account_upsert(dim, updates).collect()}
    assert set(got) == {"a", "b", "c"} and names
    assert (got["a"].account_path, got["a"].account_deps, got["a"].voters, got["a"].apply_role_arn) == (None, ["c"], None, None)
    assert got["b"].account_path == "q"


def test_append_is_all_or_nothing(spark, make_runs, tmp_path):
    good = make_runs(dict(execution_id="r1"), dict(execution_id="r2"))
    assert D.write_stack(good, f"{tmp_path}/runs").count() == 2
    bad = make_runs(dict(execution_id="r3"), dict(execution_id="r4", min_approval_count=-1))
    with pytest.raises(ValueError):
        D.write_stack(bad, f"{tmp_path}/runs")
    assert spark.read.parquet(f"{tmp_path}/runs").count() == 2
    more = make_runs(dict(execution_id="r2"), dict(execution_id="r5"))
    assert ids_of(D.write_stack(more, f"{tmp_path}/runs")) == ["r5"]
    assert ids_of(D.read_stack(spark, f"{tmp_path}/runs")) == ["r1", "r2", "r5"]


def test_an_append_that_died_does_not_show(spark, make_runs, tmp_path, monkeypatch):
    path = f"{tmp_path}/runs"
    D.write_stack(make_runs(dict(execution_id="r1", commit_id="c1")), path)
    new = make_runs(*[dict(execution_id=f"s{i}", commit_id="c2", account_name=f"a{i}") for i in range(9)])
    manifest = D._manifest

    def dies(folder):
        raise RuntimeError("lost")

    # The rows are written, the marker isn't.
    calls = iter([manifest, dies])
    monkeypatch.setattr(D, "_manifest", lambda folder: next(calls)(folder))
    with pytest.raises(RuntimeError):
        D.write_stack(new, path)
    monkeypatch.setattr(D, "_manifest", manifest)
    assert spark.read.parquet(path).count() == 10
    assert ids_of(D.read_stack(spark, path)) == ["r1"]
    assert D.write_stack(new, path).count() == 9
    assert D.write_stack(new, path).count() == 0
    assert ids_of(D.read_stack(spark, path)) == ["r1", *[f"s{i}" for i in range(9)]]


def test_toggle(spark):
    df = spark.createDataFrame([("Plan",), ("Apply",), ("Odd",)], "component string")
    config = F.create_map(F.lit("Plan"), F.lit(True), F.lit("Apply"), F.lit(False))
    assert [r.component for r in FL.status_toggle(df, config).collect()] == ["Plan"]
    with pytest.raises(Exception, match="no status switch for Odd"):
        FL.status_toggle(df, config, strict=True).collect()


def test_lists_of_large_groups(spark):
    df = spark.range(1000).selectExpr("if(id < 900, 'hot', 'cold') as k", "cast(id as string) as v")
    for rows in (1, 100, 10_000):
        pages = sorted(paged_list(df, ["k"], "v", "vs", page_rows=rows).collect(), key=lambda p: (p.k, p.page))
        for k, ids in (("hot", range(900)), ("cold", range(900, 1000))):
            own = [p for p in pages if p.k == k]
            assert [v for p in own for v in p.vs] == sorted(str(i) for i in ids)
            assert [p.page for p in own] == list(range(-(-len(ids) // rows)))
            assert all(len(p.vs) == rows for p in own[:-1])
    lists = {r.k: (r.n, r.vs and len(r.vs)) for r in inline_lists(df, ["k"], "v", "vs", limit=100).collect()}
    assert lists == {"hot": (900, None), "cold": (100, 100)}


def test_pages_follow_the_rank(spark):
    """Positions are line numbers of a whole log; pages count within one list, null keys too."""
    rows = [("a", 9_999, "x"), ("a", 10_000, "y"), ("a", 25_000, "z"), (None, 3, "n"), (None, 7, "m")]
    df = spark.createDataFrame(rows, "k string, pos int, v string")
    got = {(r.k, r.page): r.vs for r in ordered_pages(df, ["k"], "pos", "v", "vs", page_rows=2).collect()}
    assert got == {("a", 0): ["x", "y"], ("a", 1): ["z"], (None, 0): ["n", "m"]}
    assert ordered_pages(df.limit(0), ["k"], "pos", "v", "vs").count() == 0


def test_numbers_given_are_not_given_again(spark):
    runs = spark.createDataFrame([(5,)], "pr_id int")
    new = spark.createDataFrame([(1, None), (2, 6), (3, None)], "id int, pr_id int")
    got = {r.id: r.pr_id for r in A.next_pr_id(runs, new, "id").collect()}
    assert got == {1: 7, 2: 6, 3: 8}


@pytest.mark.parametrize("partitions", [1, 7])
def test_rows_numbered_one_by_one(spark, partitions):
    rng = random.Random(partitions)
    rows = [(i, rng.choice([None, None, rng.randrange(1, 90)])) for i in range(400)]
    expected, top = {}, 12
    for i, given in rows:
        expected[i] = top + 1 if given is None else given
        top = max(top, expected[i])
    shuffled = rng.sample(rows, len(rows))
    new = spark.createDataFrame(shuffled, "id long, pr_id int").repartition(partitions)
    runs = spark.createDataFrame([(12,), (None,), (3,)], "pr_id int")
    got = A.next_pr_id(runs, new, "id", sequential=True)
    assert {r.id: r.pr_id for r in got.collect()} == expected
    none = A.next_pr_id(runs.limit(0), new.limit(0), "id", sequential=True)
    assert none.columns == ["id", "pr_id"] and none.count() == 0
    first = A.next_pr_id(runs.limit(0), new.where("id = 0").withColumn("pr_id", F.lit(None).cast("int")), "id", sequential=True)
    assert [r.pr_id for r in first.collect()] == [1]


def partial_runs(spark, make_runs, rows):
    """Rows with ``row_key`` and the columns given, all others unset."""
    schema = make_runs().schema
    names = ["row_key", *schema.fieldNames()]
    full = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(full, T.StructType([T.StructField("row_key", T.LongType()), *schema.fields]))


def test_references_of_earlier_rows(spark, make_runs):
    rows = [dict(row_key=1), dict(row_key=2, base_ref="x", head_ref="topic"), dict(row_key=3), dict(row_key=4, head_ref="late")]
    partial = partial_runs(spark, make_runs, rows)
    dim = spark.createDataFrame(
        [("a", "a", 1, 1, "p", "q")],
        "account_name string, account_path string, min_approval_count int, min_rejection_count int, plan_role_arn string, apply_role_arn string",
    )

    def refs(existing):
        filled = J.fill_defaults(partial, dim, existing=existing)
        return {r.row_key: (r.pr_id, r.base_ref, r.head_ref) for r in filled.collect()}

    empty = make_runs().select("pr_id", "base_ref", "head_ref")
    assert refs(empty) == {1: (1, "master", None), 2: (2, "x", "topic"), 3: (3, "master", "topic"), 4: (4, "master", "late")}
    known = make_runs(dict(execution_id="r", pr_id=7, base_ref="trunk", head_ref="old"))
    assert refs(known) == {1: (8, "trunk", "old"), 2: (9, "x", "topic"), 3: (10, "trunk", "old"), 4: (11, "trunk", "late")}


def test_bad_run_documents_are_reported(spark):
    docs = {
        1: '{"execution_id":"r","status":"failed","is_rollback":false,"commit_id":"c","cfg_path":"p"}',
        2: '{"execution_id":"r","status":"failed","commit_id":"c","cfg_path":"p"}',
        3: "no json",
        4: "[1]",
    }
    raw = spark.createDataFrame([(i, 1, d, None, "X") for i, d in docs.items()], "event_id int, ts int, output string, input string, status string")
    got = {r.event_id: r.error for r in E.run_event_scan(raw).collect()}
    bad = "run document is not a JSON object"
    assert got == {1: None, 2: "missing: is_rollback", 3: bad, 4: bad}


def test_bad_state_documents_are_reported(spark, make_runs):
    runs = make_runs(*[dict(execution_id=f"r{i}", new_providers=["p"]) for i in range(4)])
    state = '{"resources":[{"type":"t","name":"n","provider":"x[\\"p\\"]"}]}'
    docs = spark.createDataFrame([("r0", state), ("r1", "{bad"), ("r2", ""), ("r3", "[]")], "execution_id string, doc string")
    got = {r.execution_id: (r.new_resources, r.error) for r in S.new_resources(docs, runs).collect()}
    bad = "state document is not a JSON object"
    assert got == {"r0": (["t.n"], None), "r1": (None, bad), "r2": ([], None), "r3": (None, bad)}


def test_merged_must_be_a_json_value(spark):
    def event(merged):
        ref = '{"sha":"s","ref":"r"}'
        return (
            '{"action":"opened","repository":{"full_name":"o/r"},"pull_request":{"merged":' + merged
            + f',"number":1,"base":{ref},"head":{ref}}}}}'
        )

    bodies = {1: "false", 2: '"no"', 3: '"false"', 4: "null"}
    raw = spark.createDataFrame([(i, 1, {"x-github-event": "pull_request"}, event(m)) for i, m in bodies.items()], "event_id int, ts int, headers struct<`x-github-event`:string,`x-hub-signature-256`:string>, body string")
    got = {r.event_id: (r.route, r.body_error, r.number) for r in FL.webhook_route(E.webhook_scan(raw)).collect()}
    assert got == {1: ("open", None, 1), **{i: (None, "missing: merged", 1) for i in (2, 3, 4)}}


def test_fill_defaults_is_stable(spark, make_runs):
    empty = make_runs().drop("status")
    assert J.fill_dim_defaults(
        spark.createDataFrame(
            [(1, None, None, None, None, None, None)],
            "row_key int, account_name string, account_path string, account_deps array<string>,"
            "min_approval_count int, min_rejection_count int, voters array<string>",
        )
    ).collect()[0].account_name.startswith("account-")
    assert empty.count() == 0


def test_vote_split(spark):
    votes = spark.createDataFrame([(1, "a"), (2, "b"), (3, "ghost")], "vote_id int, execution_id string")
    live = spark.createDataFrame([("a", "RUNNING"), ("b", "SUCCEEDED")], "execution_id string, status string")
    got = {r.vote_id: (r.accepted, r.message) for r in J.vote_running_semi(votes, live).collect()}
    assert got == {
        1: (True, None),
        2: (False, "Approval submissions are not available anymore -- Execution Status: SUCCEEDED"),
    }
