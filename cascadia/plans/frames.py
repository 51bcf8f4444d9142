"""Derived tables that need arrays or structs, built on the shared views."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cascadia.functions.text import empty_list, hmac_sha256
from cascadia.model import DIM_COLUMNS, RUN_COLUMNS
from cascadia.operators.filters import run_event_filter
from cascadia.plans.views import SECRET, Tables
from cascadia.session import measured
from cascadia.sources.events import run_event_scan
from cascadia.sources.logs import new_providers


def dim(t: Tables) -> DataFrame:
    """Account table; an account has at most one parent and one voter team per segment.

    It is stored and measured once per set of tables.
    """
    return t.once("dim", lambda: measured(_dim(t)))


def _dim(t: Tables) -> DataFrame:
    teams = t["account_voter"].groupBy("account_name").agg(
        F.array_sort(F.collect_set("voter")).alias("voters")
    )
    return (
        t["account_base"]
        .join(t["account_dep"], "account_name", "left")
        .join(teams, "account_name", "left")
        .withColumn("account_deps", F.array_compact(F.array("dep_name")))
        .withColumn("voters", F.coalesce(F.col("voters"), empty_list()))
        .select(DIM_COLUMNS)
    )


def nodes(t: Tables) -> DataFrame:
    return t["cfg_node"].select(F.col("account_name").alias("graph_id"), "cfg_path")


def edges(t: Tables) -> DataFrame:
    return t["cfg_edge"].select(
        F.col("account_name").alias("graph_id"), "cfg_path", "dep_path", "pos"
    )


def runs(t: Tables) -> DataFrame:
    """Run table; a directory has at most two dependencies here."""

    def dep(pos: int):
        return F.max(F.when(F.col("pos") == pos, F.col("dep_path")))

    deps = t["cfg_edge"].groupBy("cfg_key").agg(
        F.array_compact(F.array(dep(0), dep(1))).alias("cfg_deps")
    )
    accounts = dim(t).drop("account_path")
    return (
        t["run_base"]
        .join(deps, "cfg_key", "left")
        .join(accounts, "account_name")
        .withColumns(
            {
                "pr_id": F.col("pr_id").cast("int"),
                "base_ref": F.lit("trunk"),
                "head_ref": F.concat(F.lit("feature-"), F.col("pr_id").cast("string")),
                "cfg_deps": F.coalesce(F.col("cfg_deps"), empty_list()),
                "plan_command": F.concat(F.lit("plan "), F.col("cfg_path")),
                "apply_command": F.concat(F.lit("apply "), F.col("cfg_path")),
                "new_providers": F.when(
                    (F.col("pr_id") + F.col("cfg_key")) % 4 != 0, F.array("provider")
                ).otherwise(empty_list()),
                "new_resources": F.array_compact(F.array("resource_a", "resource_b")),
                "approval_voters": empty_list(),
                "rejection_voters": empty_list(),
            }
        )
        .select(RUN_COLUMNS)
    )


def looped_runs(t: Tables) -> DataFrame:
    """Runs of which some wait for each other."""
    back = t["back_edge"].select("cfg_path", F.array("dep_path").alias("_back"))
    found = runs(t).join(back, "cfg_path", "left")
    deps = F.concat("cfg_deps", F.coalesce("_back", empty_list()))
    return found.withColumn("cfg_deps", deps).select(RUN_COLUMNS)


def mixed_runs(t: Tables) -> DataFrame:
    """Runs of which some commits already have rollback rows."""
    return t["run_base"].withColumn(
        "is_rollback", (F.col("status") == "aborted") & (F.col("pr_id") % 3 == 0) & F.col("resource_b").isNotNull()
    )


def files(t: Tables) -> DataFrame:
    return t["changed_file"].select("pr_id", "commit_id", "filename", "status")


def commits(t: Tables) -> DataFrame:
    return t["supplier"].select(
        F.md5(F.col("s_suppkey").cast("string")).alias("commit_id"),
        F.col("s_suppkey").cast("int").alias("pr_id"),
        F.lit("trunk").alias("base_ref"),
        F.concat(F.lit("feature-"), F.col("s_suppkey").cast("string")).alias("head_ref"),
    )


def raw_webhooks(t: Tables) -> DataFrame:
    good = hmac_sha256(SECRET, F.col("body"))
    signature = (
        F.when(F.col("sig_kind") == "prefix", F.concat(F.lit("sha1="), good))
        .when(F.col("sig_kind") == "digest", F.concat(F.lit("sha256="), F.md5("body")))
        .otherwise(F.concat(F.lit("sha256="), good))
    )
    return t["webhook_body"].select(
        "event_id",
        "ts",
        F.struct(
            F.col("event_kind").alias("x-github-event"), signature.alias("x-hub-signature-256")
        ).alias("headers"),
        "body",
    )


def vote_runs(t: Tables) -> DataFrame:
    return t["vote_run"].select(
        "execution_id",
        F.array_compact(F.array("first_approval")).alias("approval_voters"),
        F.array_compact(F.array("first_rejection")).alias("rejection_voters"),
        "min_approval_count",
        "min_rejection_count",
    )


def finished(t: Tables) -> DataFrame:
    return run_event_scan(run_event_filter(t["run_event_doc"]))


def repo_runs(t: Tables) -> DataFrame:
    """Runs with the repository of their pull request."""
    repos = (
        t["supplier"]
        .join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("s_suppkey").alias("pr_id"), F.col("n_name").alias("repo"))
    )
    return t["run_base"].join(repos, "pr_id")


def providers(t: Tables) -> DataFrame:
    return new_providers(t["provider_log"])
