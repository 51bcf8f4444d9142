"""One query per operator over the derived rollout tables.

Lists are joined to text, since the result check compares scalars.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascadia.functions.lists import inline_lists
from cascadia.functions import text as X
from cascadia.functions.text import empty_list
from cascadia.operators import aggregates as A
from cascadia.operators import filters as FL
from cascadia.operators import graph as G
from cascadia.operators import joins as J
from cascadia.operators import lifecycle as L
from cascadia.operators import vote_requests as R
from cascadia.operators import votes as V
from cascadia.plans import frames as P
from cascadia.plans.views import SECRET, Tables
from cascadia.session import tune
from cascadia.sources import events as E
from cascadia.sources import logs as S
from cascadia.sources import tables as D

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

APPROVAL_URL = "https://approve.example/"
STATUS_CONFIG = {"PrPlan": True, "Plan": False, "Apply": True}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register ``build`` under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Tables(tune(spark), folder))

    run.__name__ = build.__name__
    QUERIES[build.__name__] = run
    return build


def text(column: str, separator: str = "|"):
    return F.array_join(F.col(column), separator).alias(column)


# --- sources, sinks -------------------------------------------------------------------


@query
def account_upsert(t):
    updates = t["account_update"].withColumns(
        {
            "account_deps": empty_list(),
            "voters": empty_list(),
            "apply_role_arn": F.lit("arn:apply/new"),
        }
    )
    return D.account_upsert(P.dim(t), updates).select(
        "account_name",
        "account_path",
        "min_approval_count",
        "min_rejection_count",
        text("voters"),
        "plan_role_arn",
        "apply_role_arn",
    )


@query
def account_scan(t):
    raw = P.dim(t).withColumns(
        {
            c: F.concat(F.lit("{"), F.array_join(c, ", "), F.lit("}"))
            for c in ("account_deps", "voters")
        }
    )
    return D.account_scan(raw).select(
        "account_name",
        "account_path",
        F.size("account_deps").alias("n_deps"),
        text("account_deps"),
        text("voters"),
    )


@query
def changed_file_scan(t):
    return D.changed_file_scan(P.files(t))


@query
def webhook_scan(t):
    return E.webhook_scan(P.raw_webhooks(t)).drop("headers", "body", "body_error", "is_json")


@query
def run_event_scan(t):
    return E.run_event_scan(t["run_event_doc"])


@query
def new_resources(t):
    return S.new_resources(t["state_doc"], P.runs(t)).select("execution_id", text("new_resources", ","))


@query
def dependency_edges(t):
    logs = t["graph_log"]
    edges = S.dependency_edges(logs).select("graph_id", "cfg_path", "dep_path", "pos")
    nodes = S.dependency_nodes(logs).select(
        "graph_id",
        "cfg_path",
        F.lit(None).cast("string").alias("dep_path"),
        F.lit(-1).alias("pos"),
    )
    return edges.unionByName(nodes)


@query
def new_providers(t):
    return S.new_providers(t["provider_log"]).select("graph_id", "cfg_path", text("new_providers"))


@query
def plan_diff_dirs(t):
    return S.plan_diff_dirs(t["plan_log"])


@query
def inline_stack(t):
    rows = P.runs(t).select(
        "cfg_path",
        F.array_join("cfg_deps", ",").alias("cfg_deps"),
        F.array_join("new_providers", ",").alias("new_providers"),
    )
    return D.inline_stack(rows).select(
        "cfg_path",
        F.size("cfg_deps").alias("n_deps"),
        text("cfg_deps"),
        F.size("new_providers").alias("n_providers"),
    )


@query
def stack_append(t):
    stack = _deploy_stack(t)
    old = P.runs(t).drop("cfg_deps").select(stack.runs.columns)
    after = D.stack_append(
        old.withColumn("is_new", F.lit(False)), stack.runs.withColumn("is_new", F.lit(True))
    )
    return after.select("commit_id", "account_name", "cfg_path", "status", "is_new")


@query
def keyed_update(t):
    updates = (
        t["run_event"]
        .groupBy("execution_id")
        .agg(F.max(F.lower("status")).alias("status"), F.max("cfg_path").alias("cfg_path"))
        .filter(F.col("status") != "succeeded")
    )
    return D.keyed_update(t["run_base"], updates).select("execution_id", "status", "cfg_path")


@query
def constraint_check(t):
    attempts = t["lineitem"].select(
        F.concat_ws("-", F.lit("run"), F.col("l_suppkey"), F.col("l_partkey")).alias("execution_id"),
        (F.col("l_linenumber") - 2).alias("min_approval_count"),
        (F.col("l_linenumber") - 1).alias("min_rejection_count"),
        F.concat(
            F.lit("live/"), F.when(F.col("l_quantity") > 49, F.lit("*")).otherwise(F.lit("x"))
        ).alias("account_path"),
    )
    return D.constraint_check(attempts, "execution_id", ("min_approval_count", "min_rejection_count"))


# --- filters --------------------------------------------------------------------------


@query
def config_file_filter(t):
    return FL.config_file_filter(P.files(t), P.dim(t))


@query
def pr_path_gate(t):
    return FL.pr_path_gate(t["pr_file"])


@query
def status_toggle(t):
    switches = F.create_map(
        *[F.lit(v) for pair in STATUS_CONFIG.items() for v in pair]
    )
    return FL.status_toggle(t["commit_status"], switches)


@query
def webhook_route(t):
    return FL.webhook_route(E.webhook_scan(P.raw_webhooks(t))).select("event_id", "route")


@query
def run_event_filter(t):
    return FL.run_event_filter(t["run_event_doc"]).select("event_id", "status")


@query
def commit_state(t):
    return FL.commit_state(t["run_base"])


@query
def abort_scope(t):
    return FL.abort_scope(t["run_base"], t["run_base"].filter(F.col("status") == "failed"))


@query
def lock_status(t):
    prs = t["build"].select(
        "repo", F.concat(F.lit("feature-"), F.col("pr_id").cast("string")).alias("head_ref")
    )
    return FL.lock_status(L.merge_lock(P.repo_runs(t), t["build"]), prs)


@query
def plan_change_summary(t):
    return FL.plan_change_summary(t["plan_text"])


@query
def signature_check(t):
    return FL.signature_check(P.raw_webhooks(t), SECRET).select("event_id", "sig_ok", "sig_error")


@query
def webhook_outcome(t):
    events = FL.signature_check(FL.webhook_route(E.webhook_scan(P.raw_webhooks(t))), SECRET)
    return FL.webhook_outcome(events, t["pr_file"]).select("event_id", "status_code", "message")


@query
def voter_directory(t):
    return FL.voter_directory(P.dim(t))


# --- joins ----------------------------------------------------------------------------


@query
def account_file_join(t):
    return J.account_file_join(P.dim(t), P.files(t))


def _seeds(t):
    return FL.config_file_filter(P.files(t), P.dim(t)).withColumnRenamed("account_name", "graph_id")


def _deploy_stack(t):
    found = G.closure(P.nodes(t), P.edges(t), _seeds(t))
    return G.deploy_stack(P.nodes(t), P.edges(t), found, P.providers(t), P.dim(t), P.commits(t))


@query
def stack_semi(t):
    diff = (
        FL.config_file_filter(P.files(t), P.dim(t))
        .withColumnRenamed("account_name", "graph_id")
        .withColumnRenamed("dir", "cfg_path")
    )
    keys = ["commit_id", "graph_id", "cfg_path"]
    found = J.stack_semi(P.nodes(t), P.edges(t), diff)
    lists = inline_lists(found.deps, keys, "dep_path", "cfg_deps", order="pos", limit=None)
    return found.rows.join(lists, keys, "left").select(
        *keys, F.coalesce(F.array_join("cfg_deps", "|"), F.lit("")).alias("cfg_deps")
    )


@query
def cfg_blocked(t):
    return J.cfg_blocked(P.runs(t))


@query
def account_blocked(t):
    return J.account_blocked(P.runs(t))


@query
def reverse_deps(t):
    return J.reverse_deps(P.runs(t))


@query
def rollback_guard(t):
    return J.rollback_guard(P.mixed_runs(t)).select("execution_id", "commit_id")


@query
def single_commit_scope(t):
    return J.single_commit_scope(P.mixed_runs(t)).select("execution_id", "commit_id", "is_rollback")


@query
def vote_running_semi(t):
    live = t["vote_run"].select("execution_id", F.col("live_status").alias("status"))
    return J.vote_running_semi(t["vote"], live).select("vote_id", "accepted", "message")


@query
def fill_defaults(t):
    key = F.col("o_orderkey")
    words = F.array("o_orderpriority", "o_orderstatus")

    def given(modulus: int, value, kind: str):
        return F.when(key % modulus == 0, value).cast(kind)

    partial = t["orders"].select(
        key.alias("row_key"),
        F.when(key % 5 != 0, F.concat(F.lit("NATION_"), (F.col("o_custkey") % 30).cast("string"))).alias(
            "account_name"
        ),
        (key % 2 == 0).alias("is_rollback"),
        given(3, key + 7, "int").alias("pr_id"),
        given(4, F.concat(F.lit("c"), key.cast("string")), "string").alias("commit_id"),
        given(7, F.lit("other"), "string").alias("base_ref"),
        given(2, F.lit("feature"), "string").alias("head_ref"),
        given(6, F.concat(F.lit("dir/"), key.cast("string")), "string").alias("cfg_path"),
        given(9, F.lit("waiting"), "string").alias("status"),
        given(11, F.lit("plan it"), "string").alias("plan_command"),
        given(8, key % 4, "int").alias("min_approval_count"),
        F.when(key % 10 != 1, words).alias("voters"),
        *[
            F.lit(None).cast("string").alias(c)
            for c in ("execution_id", "apply_command", "account_path", "plan_role_arn", "apply_role_arn")
        ],
        F.lit(None).cast("int").alias("min_rejection_count"),
        *[
            F.lit(None).cast("array<string>").alias(c)
            for c in (
                "cfg_deps",
                "new_providers",
                "new_resources",
                "account_deps",
                "approval_voters",
                "rejection_voters",
            )
        ],
    )
    runs = t["run_base"].select("pr_id", F.lit("trunk").alias("base_ref"), F.concat(F.lit("feature-"), "pr_id").alias("head_ref"))
    return J.fill_defaults(partial, P.dim(t), existing=runs).select(
        "row_key",
        "account_name",
        "account_path",
        "execution_id",
        "commit_id",
        "pr_id",
        "base_ref",
        "head_ref",
        "cfg_path",
        "status",
        "plan_command",
        "apply_command",
        "min_approval_count",
        "min_rejection_count",
        "plan_role_arn",
        "apply_role_arn",
        text("voters"),
        text("approval_voters"),
        text("rejection_voters"),
    )


@query
def fill_dim_defaults(t):
    key = F.col("c_custkey")

    def given(modulus: int, value, kind: str):
        return F.when(key % modulus == 0, value).cast(kind)

    partial = t["customer"].select(
        key.alias("row_key"),
        given(3, F.col("c_name"), "string").alias("account_name"),
        given(4, F.concat(F.lit("live/"), F.col("c_mktsegment")), "string").alias("account_path"),
        F.when(key % 5 == 0, F.array("c_mktsegment")).alias("account_deps"),
        given(7, key % 4, "int").alias("min_approval_count"),
        F.lit(None).cast("int").alias("min_rejection_count"),
        F.when(key % 2 == 0, F.array("c_name", "c_mktsegment")).alias("voters"),
    )
    return J.fill_dim_defaults(partial).select(
        "row_key",
        "account_name",
        "account_path",
        text("account_deps"),
        "min_approval_count",
        "min_rejection_count",
        text("voters"),
    )


@query
def abort_live_match(t):
    base = t["run_base"]
    live = base.filter(F.col("resource_a").isNotNull()).select(
        "execution_id", F.concat(F.lit("live:"), F.col("execution_id")).alias("run_ref")
    )
    return J.abort_live_match(base.filter(F.col("status") == "aborted"), live)


@query
def next_unseen_run(t):
    seen = t["run_base"].filter(F.col("resource_a").isNotNull())
    return J.next_unseen_run(t["run_base"], seen).select("commit_id", "execution_id", "status")


@query
def voter_fanout(t):
    runs = P.runs(t).filter(F.col("status") == "running").select(
        "execution_id",
        F.concat(F.lit("arn:run:*~ "), "execution_id").alias("execution_arn"),
        F.lit("arn:machine/m 1").alias("machine_arn"),
        F.concat(F.lit("tok+/="), "commit_id").alias("task_token"),
        "voters",
    )
    return J.voter_fanout(runs, APPROVAL_URL, SECRET)


def _vote_requests(t):
    """Links of running runs as requests; some are tampered with, by a digest of their vote."""
    links = voter_fanout(t).select(
        "execution_id", "voter", "action", F.substring_index("url", "?", -1).alias("query")
    )
    vote = F.concat("execution_id", "voter", "action")
    kind = F.substring(F.md5(vote), 1, 1)
    query = (
        F.when(kind == "0", F.replace("query", F.lit("256=sha256"), F.lit("256=md5")))
        .when(kind == "1", F.replace("query", F.lit("action=approve"), F.lit("action=reject")))
        .when(kind == "2", F.regexp_replace("query", "&recipient=[^&]*", ""))
        .when(kind == "3", F.regexp_replace("query", "&taskToken=[^&]*", ""))
        .otherwise(F.col("query"))
    )
    return links.select(vote.alias("vote_id"), F.lit(0).alias("ts"), query.alias("query"))


def _live(t):
    kind = F.substring(F.md5("execution_id"), 1, 1)
    return P.runs(t).filter((F.col("status") == "running") & (kind != "6")).select(
        F.concat(F.lit("arn:run:*~ "), "execution_id").alias("execution_arn"),
        F.when(kind == "5", "ABORTED").otherwise("RUNNING").alias("status"),
    )


@query
def vote_scan(t):
    return R.vote_scan(_vote_requests(t), SECRET).select(
        "vote_id", "execution_id", "voter", "action", "execution_arn", "task_token", "missing", "sig_error"
    )


@query
def vote_outcome(t):
    return R.vote_outcome(R.vote_scan(_vote_requests(t), SECRET), _live(t)).select(
        "vote_id", "status_code", "message", "accepted"
    )


@query
def plan_fanout(t):
    prs = t["orders"].filter(F.col("o_orderstatus") == "O").select(
        F.concat(F.lit("org/repo-"), F.col("o_custkey").cast("string")).alias("repo"),
        F.col("o_orderkey").alias("pr_id"),
    )
    return J.plan_fanout(prs, t["pr_file"], P.dim(t))


# --- aggregates -----------------------------------------------------------------------


@query
def changed_dirs(t):
    return A.changed_dirs(P.files(t))


@query
def ready_ids(t):
    return A.ready_ids(G.ready_frontier(P.runs(t))).select(
        "commit_id", "is_rollback", "page", text("execution_ids")
    )


@query
def voter_union(t):
    return V.voter_union(P.vote_runs(t), t["vote"]).select(
        "execution_id", text("approval_voters"), text("rejection_voters")
    )


@query
def status_rollup(t):
    lines = t["lineitem"].select(
        F.col("l_orderkey").alias("commit_id"),
        (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("pos"),
        F.when(F.col("l_quantity") > 45, "aborted")
        .when(F.col("l_quantity") > 40, "waiting")
        .when(F.col("l_returnflag") == "R", "failed")
        .otherwise("succeeded")
        .alias("status"),
    )
    return A.status_rollup(lines)


@query
def in_progress(t):
    return A.in_progress(P.repo_runs(t))


@query
def run_counts(t):
    return A.run_counts(t["run_base"])


@query
def next_pr_id(t):
    new = t["orders"].select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).cast("int").alias("pr_id"),
    )
    return A.next_pr_id(t["run_base"], new, "o_orderkey")


@query
def next_pr_id_sequential(t):
    new = t["orders"].select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey") % 5000 * 3).cast("int").alias("pr_id"),
    )
    return A.next_pr_id(t["run_base"], new, "o_orderkey", sequential=True)


@query
def delivery_failures(t):
    return A.delivery_failures(t["delivery"])


@query
def commit_paths(t):
    return A.commit_paths(t["run_base"]).select("commit_id", "page", text("cfg_paths"))


@query
def adjacency(t):
    return A.adjacency(P.nodes(t), P.edges(t)).select("graph_id", "cfg_path", "page", text("deps"))


@query
def waiting_commits(t):
    return A.waiting_commits(P.mixed_runs(t))


@query
def waiting_commits_by_repo(t):
    runs = P.repo_runs(t).where(F.col("pr_id") % 4 == 0)
    return A.waiting_commits(runs, "repo")


@query
def required_status_count(t):
    expected = t["orders"].select(
        F.md5(F.col("o_orderkey").cast("string")).alias("commit_id"),
        (F.col("o_custkey") % 6).alias("expected"),
    )
    return A.required_status_count(t["commit_status"], expected)


@query
def invocation_count(t):
    points = t["events"].select(F.col("event_type").alias("function_name"), "ts")
    return A.invocation_count(
        points,
        F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"),
        F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"),
    )


@query
def preceding_event(t):
    return A.preceding_event(t["step_event"])


@query
def latest_status(t):
    return A.latest_status(t["commit_status"]).select("commit_id", "context", "state", "status_id")


@query
def latest_stream_errors(t):
    return A.latest_stream_errors(t["log_event"]).select("log_group", "stream", "event_id", "message")


# --- graph ----------------------------------------------------------------------------


@query
def impact_closure(t):
    return G.impact_closure(P.nodes(t), P.edges(t), _seeds(t))


def _plan_diff(t):
    return G.plan_scan_diff(S.plan_diff_dirs(t["plan_log"]), P.dim(t))


@query
def plan_scan_diff(t):
    return _plan_diff(t)


@query
def deploy_stack(t):
    return _deploy_stack(t).table().select(
        "execution_id",
        "is_rollback",
        "pr_id",
        "commit_id",
        "base_ref",
        "head_ref",
        "cfg_path",
        text("cfg_deps"),
        "status",
        "plan_command",
        "apply_command",
        text("new_providers"),
        "account_name",
        "account_path",
        text("account_deps"),
        text("voters"),
        "min_approval_count",
        "min_rejection_count",
    )


@query
def ready_frontier(t):
    return G.ready_frontier(P.runs(t))


@query
def deploy_waves(t):
    return G.deploy_waves(P.runs(t))


@query
def blocked_reasons(t):
    return G.blocked_reasons(P.looped_runs(t)).drop("unknown")


@query
def cycle_members(t):
    return G.cycle_members(t["loop_edge"])


def _failed(t):
    return t["run_base"].filter(F.col("status") == "failed").select("commit_id").distinct()


@query
def rollback_stack(t):
    return G.rollback_stack(P.runs(t), _failed(t)).table().withColumn(
        "cfg_deps", F.array_sort("cfg_deps")
    ).select(
        "execution_id",
        "is_rollback",
        "commit_id",
        "cfg_path",
        text("cfg_deps"),
        "status",
        "plan_command",
        "apply_command",
        text("account_deps"),
    )


@query
def target_flags(t):
    return t["run_base"].select(
        "execution_id",
        X.target_flags(F.array_compact(F.array("resource_a", "resource_b"))).alias("flags"),
    )


# --- events and state -----------------------------------------------------------------


@query
def webhook_stream(t):
    jobs = L.webhook_jobs(P.raw_webhooks(t), t["pr_file"], P.dim(t), SECRET)
    plan = jobs.plan_jobs.select(
        F.lit("plan").alias("kind"), "event_id", "pr_id", "head_ref", "account_name", "cfg_path"
    )
    none = F.lit(None).cast("string")
    stack = jobs.stack_jobs.select(
        F.lit("stack").alias("kind"),
        "event_id",
        "pr_id",
        "head_ref",
        none.alias("account_name"),
        none.alias("cfg_path"),
    )
    return plan.unionByName(stack)


@query
def run_status_apply(t):
    return L.run_status_apply(t["run_base"], P.finished(t)).select("execution_id", "status")


@query
def failure_cascade(t):
    after = L.failure_cascade(t["run_base"], t["rare_failure"])
    runs = after.runs.select("execution_id", "status", F.lit(None).cast("string").alias("error"))
    errors = after.errors.select("execution_id", F.lit("failed rollback").alias("status"), "error")
    return runs.unionByName(errors)


@query
def rollback_on_failure(t):
    after = L.rollback_on_failure(P.runs(t), t["rare_failure"])
    return after.runs.select(
        "execution_id",
        "is_rollback",
        "status",
        "commit_id",
        "cfg_path",
        F.size("cfg_deps").alias("n_deps"),
    )


@query
def advance_rollout(t):
    after = L.advance(P.runs(t), t["rare_failure"])
    return after.runs.select("execution_id", "commit_id", "is_rollback", "status")


@query
def vote_decision(t):
    return V.vote_decision(P.vote_runs(t), t["vote"])


@query
def late_votes(t):
    return V.late_votes(P.vote_runs(t), t["vote"])


@query
def merge_lock(t):
    return L.merge_lock(P.repo_runs(t), t["build"])


@query
def finished_statuses(t):
    return L.finished_statuses(P.finished(t).where("error IS NULL"))


@query
def lock_release(t):
    """Repositories of which nothing is left to do, on runs of which most have ended."""
    ended = F.when(F.col("pr_id") % 5 == 0, F.col("status")).otherwise("succeeded")
    return L.lock_release(P.repo_runs(t).withColumn("status", ended))


@query
def plan_fanout_by_repo(t):
    """Plan jobs where an account belongs to one of the repositories that name it."""
    open_prs = t["orders"].filter(F.col("o_orderstatus") == "O")
    prs = open_prs.select(F.concat(F.lit("org/repo-"), F.col("o_custkey").cast("string")).alias("repo"), F.col("o_orderkey").alias("pr_id"))
    dim = P.dim(t).join(t["nation"].select(F.col("n_name").alias("account_name"), "n_nationkey"), "account_name")
    owners = t["customer"].select(F.col("c_custkey"), F.concat(F.lit("org/repo-"), F.col("c_custkey").cast("string")).alias("repo"))
    owned = dim.join(owners, F.col("c_custkey") % 25 == F.col("n_nationkey")).drop("c_custkey", "n_nationkey")
    return J.plan_fanout(prs, t["pr_file"], owned)


@query
def step_outcome(t):
    return L.step_outcome(t["step_event"])


@query
def start_ready(t):
    return L.start_ready(P.runs(t)).inputs
