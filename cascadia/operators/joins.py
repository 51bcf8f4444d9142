"""Joins between runs, dependencies, accounts, files and votes."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascadia.functions.paths import config_dirs, under_accounts
from cascadia.functions.text import (
    dirname,
    empty_list,
    hmac_sha256,
    link_encode,
    stable_hash,
    stable_number,
)
from cascadia.model import (
    ACTIONS,
    BLOCKING,
    OPEN_STATUSES,
    PLAN_CONTEXT,
    RUN_COLUMNS,
    VOTE_EXPIRED,
    WORK_DIR_FLAG,
)
from cascadia.operators.aggregates import next_pr_id
from cascadia.session import kept

_SCOPE = ["commit_id", "is_rollback"]


def account_file_join(dim: DataFrame, files: DataFrame) -> DataFrame:
    """Every changed file with every account whose path it lies under."""
    accounts = dim.select("account_name", "account_path")
    return under_accounts(files, accounts, dirname(F.col("filename"))).select(
        *files.columns, "account_name"
    )


class StackRows(NamedTuple):
    """Directories to deploy and, in long form, their dependencies among them."""

    rows: DataFrame  # commit_id, graph_id, cfg_path
    deps: DataFrame  # commit_id, graph_id, cfg_path, dep_path, pos


def stack_semi(
    nodes: DataFrame, edges: DataFrame, diff: DataFrame, graph: str = "graph_id"
) -> StackRows:
    """Sub-graph of each commit's changed directories.

    A directory without a remaining dependency stays in ``rows``.
    """
    keys = ["commit_id", graph, "cfg_path"]
    # The diff is needed several times, so it is stored instead of computed again.
    diff = kept(diff.select(keys))
    rows = diff.join(nodes, [graph, "cfg_path"], "left_semi").select(keys)
    changed = diff.select("commit_id", graph, F.col("cfg_path").alias("dep_path"))
    deps = (
        rows.join(edges.select(graph, "cfg_path", "dep_path", "pos"), [graph, "cfg_path"])
        .join(changed, ["commit_id", graph, "dep_path"], "left_semi")
        .select(*keys, "dep_path", "pos")
    )
    return StackRows(rows, deps)


def run_deps(runs: DataFrame, deps: DataFrame | None = None) -> DataFrame:
    """Directory dependencies of the runs in long form: their lists, and ``deps`` as given."""
    found = None
    if "cfg_deps" in runs.columns:
        found = runs.select(
            "execution_id", *_SCOPE, F.explode("cfg_deps").alias("dep_path")
        ).filter(F.col("dep_path").isNotNull())
    if deps is not None:
        long = (
            deps.select("execution_id", "dep_path")
            .join(runs.select("execution_id", *_SCOPE), "execution_id")
            .select("execution_id", *_SCOPE, "dep_path")
        )
        found = long if found is None else found.unionByName(long)
    return found


def with_known_deps(runs: DataFrame, deps: DataFrame | None = None) -> DataFrame:
    """Runs whose dependency list is known: not NULL, or held in ``deps``."""
    if "cfg_deps" not in runs.columns:
        return runs
    known = runs.filter(F.col("cfg_deps").isNotNull())
    if deps is None:
        return known
    long = runs.filter(F.col("cfg_deps").isNull()).join(
        deps.select("execution_id").distinct(), "execution_id", "left_semi"
    )
    return known.unionByName(long.select(known.columns))


def cfg_blocked(runs: DataFrame, deps: DataFrame | None = None) -> DataFrame:
    """Waiting runs with a dependency on a directory that is still pending in their commit.

    ``deps`` adds dependency lists kept in long form.
    """
    wanted = run_deps(runs.filter(F.col("status") == "waiting"), deps)
    pending = (
        runs.filter(F.col("status").isin(*BLOCKING))
        .select(*_SCOPE, F.col("cfg_path").alias("dep_path"))
        .distinct()
    )
    return (
        wanted.join(pending, [*_SCOPE, "dep_path"], "left_semi")
        .select("execution_id")
        .distinct()
    )


def blocked_account_lists(runs: DataFrame) -> DataFrame:
    """Distinct ``commit, account_deps`` lists that name an account still pending in the commit.

    Runs of one account share one list, so grouping first leaves a few rows per commit.
    """
    lists = (
        runs.filter(F.col("status") == "waiting").select(*_SCOPE, "account_deps").distinct()
    )
    pending = (
        runs.filter(F.col("status").isin(*BLOCKING))
        .select(*_SCOPE, F.col("account_name").alias("_account"))
        .distinct()
    )
    return (
        lists.withColumn("_account", F.explode("account_deps"))
        .join(pending, [*_SCOPE, "_account"], "left_semi")
        .select(*_SCOPE, "account_deps")
        .distinct()
    )


def account_blocked(runs: DataFrame) -> DataFrame:
    """Waiting runs whose account depends on an account still pending in their commit."""
    return (
        runs.filter(F.col("status") == "waiting")
        .join(blocked_account_lists(runs), [*_SCOPE, "account_deps"], "left_semi")
        .select("execution_id")
    )


def reverse_deps(runs: DataFrame, deps: DataFrame | None = None) -> DataFrame:
    """``commit_id, cfg_path, dep_path``: who depends on a directory, both with new resources.

    Long form: a shared directory may have any number of dependents. ``deps``
    (``execution_id, dep_path``) holds the lists that are too long for a row. Rollback rows
    of the commit are not told apart; :func:`rollback_guard` keeps them out.
    """
    created = runs.filter(F.size("new_resources") > 0)
    dependents = created.select(
        "commit_id", F.explode("cfg_deps").alias("cfg_path"), F.col("cfg_path").alias("dep_path")
    )
    if deps is not None:
        long = created.filter(F.col("cfg_deps").isNull()).select("execution_id", "commit_id", "cfg_path")
        dependents = dependents.unionByName(
            deps.select("execution_id", "dep_path")
            .join(long, "execution_id")
            .select("commit_id", F.col("dep_path").alias("cfg_path"), F.col("cfg_path").alias("dep_path"))
        )
    # Only membership matters on the other side, so the hot directory is on the side
    # a semi join can split.
    return dependents.join(
        created.select("commit_id", "cfg_path").distinct(), ["commit_id", "cfg_path"], "left_semi"
    )


def rollback_guard(runs: DataFrame) -> DataFrame:
    """Runs of commits that have no rollback yet."""
    rolled_back = runs.filter("is_rollback").select("commit_id").distinct()
    return runs.join(rolled_back, "commit_id", "left_anti")


def single_commit_scope(runs: DataFrame, strict: bool = False) -> DataFrame:
    """Runs of the commits that wait.

    ``strict`` is the one-commit rule: more than one waiting ``(commit_id, is_rollback)``
    fails the query; :func:`~cascadia.operators.aggregates.waiting_commits` lists them.
    """
    waiting = runs.filter(F.col("status") == "waiting").select(*_SCOPE).distinct()
    if strict:
        return runs.filter(
            (F.col("commit_id") == waiting.select("commit_id").scalar())
            & (F.col("is_rollback") == waiting.select("is_rollback").scalar())
        )
    return runs.join(waiting, _SCOPE, "left_semi")


def vote_running_semi(votes: DataFrame, live: DataFrame) -> DataFrame:
    """Votes with ``accepted`` and, for those on a run that is not running, the rejection text."""
    state = live.select("execution_id", F.col("status").alias("_live"))
    return votes.join(state, "execution_id").select(
        *votes.columns,
        (F.col("_live") == "RUNNING").alias("accepted"),
        F.when(
            F.col("_live") != "RUNNING",
            F.concat(F.lit(VOTE_EXPIRED), F.col("_live")),
        ).alias("message"),
    )


def _one_or_two(*key: Column) -> Column:
    return (F.lit(1) + stable_number(*key) % 2).cast("int")


def fill_dim_defaults(partial: DataFrame, seed: str = "0") -> DataFrame:
    """Account rows with unset columns filled; ``row_key`` tells rows apart."""
    salt, key = F.lit(seed), F.col("row_key").cast("string")
    filled = partial.withColumn(
        "account_name",
        F.coalesce(
            "account_name",
            F.concat(F.lit("account-"), F.substring(stable_hash(salt, key, F.lit("name")), 1, 3)),
        ),
    )
    path_tail = F.substring(stable_hash(salt, key, F.lit("path")), 1, 7)
    return filled.withColumns(
        {
            "account_path": F.coalesce(
                "account_path", F.concat(F.col("account_name"), F.lit("/"), path_tail)
            ),
            "account_deps": F.coalesce(F.col("account_deps"), empty_list()),
            "min_approval_count": F.coalesce(
                F.col("min_approval_count"), _one_or_two(salt, key, F.lit("approval"))
            ),
            "min_rejection_count": F.coalesce(
                F.col("min_rejection_count"), _one_or_two(salt, key, F.lit("rejection"))
            ),
            "voters": F.coalesce(F.col("voters"), empty_list()),
        }
    )


def _refs_so_far(partial: DataFrame, existing: DataFrame, default: dict[str, Column]) -> dict[str, Column]:
    """The references that an unset one takes: those of existing runs, else of the rows before.

    The first row has its own base reference, set or default, so that is what later rows find. A
    head reference has no default, and rows before the first that is set stay without.
    """
    out = {}
    for name in ("base_ref", "head_ref"):
        known = F.lit(None).cast("string")
        if name in existing.columns:
            known = existing.agg(F.min(name).alias("known")).scalar()
        if name == "base_ref":
            first = partial.agg(F.min_by(name, "row_key").alias("first")).scalar()
            out[name] = F.coalesce(known, first, default[name])
        else:
            given = partial.where(F.col(name).isNotNull())
            first = given.agg(F.min(F.struct("row_key", name)).alias("first")).scalar()
            later = F.when(F.col("row_key") > first.getField("row_key"), first.getField(name))
            out[name] = F.coalesce(known, later, default[name])
    return out


def fill_defaults(
    partial: DataFrame,
    dim: DataFrame,
    seed: str = "0",
    existing: DataFrame | None = None,
    base_ref: str = "master",
    head_ref: str | None = None,
) -> DataFrame:
    """Run rows with unset columns filled from the account table, then from fixed rules.

    ``partial`` has the run columns and ``row_key``. Where a random value would do, the
    hash of seed and row key is used, so a retried task gives the same row. With ``existing``
    runs the rows are filled as if they were added to them one by one, in row-key order: an unset
    PR number is one more than the highest so far, and unset references are those of the runs so
    far, the least where they differ; ``base_ref`` and ``head_ref`` hold for rows before the first.
    """
    salt, key = F.lit(seed), F.col("row_key").cast("string")

    def tail(what: str, n: int) -> Column:
        return F.substring(stable_hash(salt, key, F.lit(what)), 1, n)

    known = dim.select(
        "account_name",
        *[
            F.col(c).alias(f"_{c}")
            for c in (
                "account_path",
                "min_approval_count",
                "min_rejection_count",
                "plan_role_arn",
                "apply_role_arn",
            )
        ],
    )
    refs = {"base_ref": F.lit(base_ref), "head_ref": F.lit(head_ref).cast("string")}
    if existing is not None:
        refs = _refs_so_far(partial, existing, refs)
    rows = partial.join(known, "account_name", "left")
    # The account row is looked up before an unset name is made up.
    rows = rows.withColumn(
        "account_name", F.coalesce("account_name", F.concat(F.lit("account-"), tail("name", 3)))
    )
    rows = rows.withColumns(
        {
            "account_path": F.coalesce("account_path", "_account_path", "account_name"),
            "account_deps": F.coalesce(F.col("account_deps"), empty_list()),
            "min_approval_count": F.coalesce(
                F.col("min_approval_count"),
                F.col("_min_approval_count"),
                _one_or_two(salt, key, F.lit("approval")),
            ),
            "min_rejection_count": F.coalesce(
                F.col("min_rejection_count"),
                F.col("_min_rejection_count"),
                _one_or_two(salt, key, F.lit("rejection")),
            ),
            "voters": F.coalesce(F.col("voters"), empty_list()),
            "plan_role_arn": F.coalesce(
                F.col("plan_role_arn"),
                F.col("_plan_role_arn"),
                F.concat("account_name", F.lit("-plan-role")),
            ),
            "apply_role_arn": F.coalesce(
                F.col("apply_role_arn"),
                F.col("_apply_role_arn"),
                F.concat("account_name", F.lit("-deploy-role")),
            ),
            "cfg_deps": F.coalesce(F.col("cfg_deps"), empty_list()),
            "execution_id": F.coalesce("execution_id", F.concat(F.lit("run-"), tail("id", 7))),
            "commit_id": F.coalesce("commit_id", tail("commit", 32)),
            "base_ref": F.coalesce("base_ref", refs["base_ref"]),
            "head_ref": F.coalesce("head_ref", refs["head_ref"]),
            "new_providers": F.coalesce(F.col("new_providers"), empty_list()),
            "new_resources": F.coalesce(F.col("new_resources"), empty_list()),
        }
    )
    rows = rows.withColumns(
        {
            "approval_voters": F.coalesce(
                F.col("approval_voters"), F.slice("voters", F.lit(1), F.col("min_approval_count"))
            ),
            "rejection_voters": F.coalesce(
                F.col("rejection_voters"), F.slice("voters", F.lit(1), F.col("min_rejection_count"))
            ),
            "cfg_path": F.coalesce(
                "cfg_path", F.concat("account_path", F.lit("/"), tail("dir", 7))
            ),
        }
    )
    verb = F.when(F.col("is_rollback"), "destroy")
    work_dir = F.concat(F.lit(WORK_DIR_FLAG), F.col("cfg_path"))
    rows = rows.withColumns(
        {
            "status": F.coalesce(
                F.col("status"),
                F.when(F.size("approval_voters") == F.col("min_approval_count"), "succeeded").when(
                    F.size("rejection_voters") == F.col("min_rejection_count"), "failed"
                ),
            ),
            "plan_command": F.coalesce(
                "plan_command",
                F.concat(
                    F.lit("terragrunt "), verb.when(~F.col("is_rollback"), "plan"), work_dir
                ),
            ),
            "apply_command": F.coalesce(
                "apply_command",
                F.concat(
                    F.lit("terragrunt "),
                    verb.when(~F.col("is_rollback"), "apply"),
                    work_dir,
                    F.lit(" -auto-approve"),
                ),
            ),
        }
    )
    if existing is not None:
        rows = next_pr_id(existing, rows, "row_key", sequential=True)
    return rows.select("row_key", *RUN_COLUMNS)


def abort_live_match(aborted: DataFrame, live: DataFrame) -> DataFrame:
    """Aborted runs with the live run to stop; those without one have ``found`` false."""
    return aborted.select("execution_id").join(live, "execution_id", "left").select(
        "execution_id", "run_ref", F.col("run_ref").isNotNull().alias("found")
    )


def next_unseen_run(runs: DataFrame, seen: DataFrame) -> DataFrame:
    """Per commit the first run by id that is under way or broken and not in ``seen``."""
    rest = [c for c in runs.columns if c != "commit_id"]
    return (
        runs.filter(F.col("status").isin("running", "aborted", "failed"))
        .join(seen.select("execution_id").distinct(), "execution_id", "left_anti")
        .groupBy("commit_id")
        .agg(F.min_by(F.struct(*rest), F.col("execution_id")).alias("_run"))
        .select("commit_id", "_run.*")
    )


def voter_fanout(runs: DataFrame, base_url: str, secret: str) -> DataFrame:
    """One signed link per run, voter and action.

    ``runs`` needs ``execution_id, execution_arn, machine_arn, task_token, voters``.
    """
    digest = hmac_sha256(secret, F.concat("execution_id", "voter", "action"))
    params = [
        ("ex", F.col("execution_id")),
        ("exArn", F.col("execution_arn")),
        ("sm", F.col("machine_arn")),
        ("recipient", F.col("voter")),
        ("taskToken", F.col("task_token")),
        ("action", F.col("action")),
        ("X-SES-Signature-256", F.concat(F.lit("sha256="), digest)),
    ]
    query = F.concat_ws(
        "&", *[F.concat(F.lit(f"{name}="), link_encode(value)) for name, value in params]
    )
    return (
        runs.select(
            "execution_id",
            "execution_arn",
            "machine_arn",
            "task_token",
            F.explode("voters").alias("voter"),
        )
        .withColumn("action", F.explode(F.array(*[F.lit(a) for a in ACTIONS])))
        .select(
            "execution_id",
            "voter",
            "action",
            F.concat(F.lit(base_url), F.lit("ses?"), query).alias("url"),
        )
    )


def plan_fanout(prs: DataFrame, files: DataFrame, dim: DataFrame) -> DataFrame:
    """One plan job per open PR, account and added or modified configuration directory.

    PRs and files are keyed by ``repo, pr_id``; only the files of the given PRs are cut into
    directories. Where accounts have a ``repo``, a file only meets those of its own.
    """
    owner = ["repo"] if "repo" in dim.columns else []
    accounts = dim.select("account_name", "account_path", "plan_role_arn", *owner)
    key = ["repo", "pr_id"]
    own = files.join(prs.select(*key).distinct(), key, "left_semi")
    dirs = config_dirs(own, key, OPEN_STATUSES)
    jobs = under_accounts(dirs, accounts, F.col("dir"), owner).select(
        *key,
        "account_name",
        F.col("dir").alias("cfg_path"),
        F.col("plan_role_arn").alias("role_arn"),
        F.concat(F.lit(PLAN_CONTEXT), F.col("dir")).alias("context"),
    )
    return prs.join(jobs, key).select(
        *prs.columns, "account_name", "cfg_path", "role_arn", "context"
    )
