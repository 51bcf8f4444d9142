"""What events do to runs: status updates, failure cascade, rollback, locks, starts."""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cascadia.model import (
    BROKEN,
    FILE_PATH_PATTERN,
    IN_PROGRESS,
    ROLLBACK_FAILED,
    RUN_COLUMNS,
    RUN_STATUS_TEXT,
    STATES,
    UNLOCKED,
)
from cascadia.operators.filters import (
    commit_state,
    signature_check,
    webhook_outcome,
    webhook_route,
)
from cascadia.operators.graph import Stack, ready_frontier, rollback_stack
from cascadia.operators.joins import plan_fanout
from cascadia.session import cut, kept, measured
from cascadia.sources.events import webhook_scan
from cascadia.sources.tables import keyed_update


class WebhookJobs(NamedTuple):
    outcome: DataFrame
    plan_jobs: DataFrame
    stack_jobs: DataFrame


def webhook_jobs(
    raw: DataFrame,
    files: DataFrame,
    dim: DataFrame,
    secret: str,
    pattern: str = FILE_PATH_PATTERN,
) -> WebhookJobs:
    """Outcome of every webhook event, the plan jobs of opened PRs, the stack job of merged ones.

    ``raw`` is a table or one micro-batch; ``files`` is keyed by ``repo, pr_id``. The outcome
    is stored once, as both kinds of jobs are made from it.
    """
    events = signature_check(webhook_route(webhook_scan(raw)), secret)
    outcome = cut(webhook_outcome(events, files, pattern))
    head = ["event_id", "repo", "base_ref", "head_ref", "base_sha", "head_sha"]
    accepted = outcome.filter("accepted").select(
        *head, F.col("number").alias("pr_id"), "route"
    )
    opened = accepted.filter(F.col("route") == "open").select(
        "event_id", "repo", "pr_id", "head_ref", "head_sha"
    )
    merged = accepted.filter(F.col("route") == "merge").select(
        "event_id", "repo", "pr_id", "base_ref", "head_ref", "base_sha", "head_sha"
    )
    return WebhookJobs(outcome, plan_fanout(opened, files, dim), merged)


def run_status_apply(runs: DataFrame, run_events: DataFrame) -> DataFrame:
    """Runs with the status of their last finished event."""
    last = run_events.groupBy("execution_id").agg(
        F.max_by("status", F.struct("ts", "event_id")).alias("status")
    )
    return keyed_update(runs, last)


class Cascade(NamedTuple):
    runs: DataFrame
    errors: DataFrame


def failed_commits(finished: DataFrame) -> DataFrame:
    """Commits in which a deploy run failed or was aborted."""
    return (
        finished.filter(F.col("status").isin(*BROKEN) & ~F.col("is_rollback"))
        .select("commit_id")
        .distinct()
    )


def failure_cascade(runs: DataFrame, finished: DataFrame) -> Cascade:
    """Abort what is in progress in failed commits; a failed rollback only gives an error row."""
    hit = failed_commits(finished).withColumn("_failed", F.lit(True))
    aborted = (
        F.col("_failed") & F.col("status").isin(*IN_PROGRESS) & ~F.col("is_rollback")
    )
    after = (
        runs.join(hit, "commit_id", "left")
        .withColumn("status", F.when(aborted, "aborted").otherwise(F.col("status")))
        .select(runs.columns)
    )
    errors = finished.filter(F.col("status").isin(*BROKEN) & F.col("is_rollback")).select(
        "execution_id",
        "commit_id",
        F.lit(ROLLBACK_FAILED).alias("error"),
    )
    return Cascade(after, errors)


class Rollback(NamedTuple):
    runs: DataFrame
    stack: Stack
    errors: DataFrame


def rollback_on_failure(
    runs: DataFrame, finished: DataFrame, deps: DataFrame | None = None, limit: int | None = None
) -> Rollback:
    """Cascade, then rollback rows for the failed commits; ``runs`` holds old and new rows.

    ``deps`` holds the dependency lists of ``runs`` that are too long for a row. New rows have
    whole lists; with a ``limit``, longer ones are NULL and whole in ``stack.long_deps(limit)``.
    """
    after = failure_cascade(runs, finished)
    stack = rollback_stack(after.runs, failed_commits(finished), deps)
    return Rollback(
        after.runs.select(RUN_COLUMNS).unionByName(stack.table(limit)), stack, after.errors
    )


def merge_lock(runs: DataFrame, builds: DataFrame) -> DataFrame:
    """Lock value per repository: the PR of its last stack build, or ``none``.

    ``builds`` is ``repo, pr_id, ts, state`` with state ``started``, ``succeeded`` or
    ``failed``. The lock is released if that build failed, or if it ended and nothing
    of the repository is waiting or running.
    """
    last = builds.groupBy("repo").agg(
        F.max_by(F.struct("pr_id", "state"), F.struct("ts", "pr_id")).alias("_b")
    )
    return lock_values(last, runs)


def lock_values(last: DataFrame, runs: DataFrame) -> DataFrame:
    """Locks from the last build per repository, ``repo, _b(pr_id, state)``, and the runs."""
    busy = runs.groupBy("repo").agg(
        F.bool_or(F.col("status").isin(*IN_PROGRESS)).alias("_busy")
    )
    held = (F.col("_b.state") == "started") | (
        (F.col("_b.state") == "succeeded") & F.coalesce("_busy", F.lit(False))
    )
    return last.join(busy, "repo", "left").select(
        "repo",
        F.when(held, F.col("_b.pr_id").cast("string")).otherwise(F.lit(UNLOCKED)).alias(
            "lock_value"
        ),
    )


def step_outcome(step_events: DataFrame, key: Sequence[str] = ("execution_id",)) -> DataFrame:
    """``execution_id, path, status`` from a run's step events; ``key`` may add columns of the run.

    A run enters a state at most once, so its path is the first entry of each of the fixed
    states: six numbers per run, however often an event was delivered.
    """
    entered = F.col("type").endswith("StateEntered")
    first = [
        F.min(F.when(entered & (F.col("state") == s), F.col("id"))).alias(f"_{i}")
        for i, s in enumerate(STATES)
    ]

    def seen(condition):
        return F.coalesce(F.bool_or(condition), F.lit(False))

    succeeded = F.col("type") == "TaskSucceeded"
    facts = step_events.groupBy(*key).agg(
        *first,
        seen(F.col("type") == "TaskFailed").alias("_task_failed"),
        seen(succeeded & (F.col("state") == "Request Approval") & (F.col("output") == '"reject"')).alias(
            "_rejected"
        ),
        seen(succeeded & (F.col("state") == "Request Approval") & (F.col("output") == '"approve"')).alias(
            "_approved"
        ),
        seen(succeeded & (F.col("state") == "Apply")).alias("_applied"),
    )
    steps = F.array_sort(
        F.array_compact(
            F.array(
                *[
                    F.when(
                        F.col(f"_{i}").isNotNull(), F.struct(F.col(f"_{i}").alias("id"), F.lit(s).alias("state"))
                    )
                    for i, s in enumerate(STATES)
                ]
            )
        )
    )
    return facts.select(
        *key,
        F.array_join(steps.getField("state"), " > ").alias("path"),
        F.when(F.col("_task_failed") | F.col("_rejected"), "failed")
        .when(F.col("_approved") & F.col("_applied"), "succeeded")
        .otherwise("running")
        .alias("status"),
    )


class Advance(NamedTuple):
    runs: DataFrame
    inputs: DataFrame
    errors: DataFrame
    statuses: DataFrame
    long_deps: DataFrame


def finished_statuses(finished: DataFrame) -> DataFrame:
    """The commit status that each finished run sends: ``event_id, commit_id, context, state, description``."""
    return commit_state(finished, "event_id").select(
        "event_id",
        "commit_id",
        F.col("execution_id").alias("context"),
        "state",
        F.lit(RUN_STATUS_TEXT).alias("description"),
    )


def lock_release(runs: DataFrame) -> DataFrame:
    """``repo, lock_value`` of the repositories in which nothing waits or runs any more: the lock goes.

    Where something does, the flow goes on and the lock stays as it is.
    """
    busy = runs.groupBy("repo").agg(F.bool_or(F.col("status").isin(*IN_PROGRESS)).alias("busy"))
    return busy.filter(~F.coalesce("busy", F.lit(False))).select("repo", F.lit(UNLOCKED).alias("lock_value"))


def advance(
    runs: DataFrame, finished: DataFrame, known_deps: DataFrame | None = None, limit: int | None = None
) -> Advance:
    """Everything finished runs lead to: status, abort, rollback rows, commit statuses, what starts next.

    Only the commits that an event names are worked on; all others pass through, but for runs that
    may start. New rows have whole dependency lists, as each input is one document. With a
    ``limit``, longer ones are NULL and in ``long_deps``, and ``known_deps`` holds earlier ones.
    ``errors`` holds failed rollbacks and the events whose ``error`` says that they could not be read.
    """
    # Status, cascade and rollback all read the events, so they are stored once.
    error = F.col("error") if "error" in finished.columns else F.lit(None).cast("string")
    finished = kept(
        finished.select(
            "event_id", "ts", "execution_id", "status", "is_rollback", "commit_id", error.alias("error")
        )
    )
    # An event that lacks a field may not be guessed at: it changes nothing and is reported.
    unread = finished.filter(F.col("error").isNotNull()).select("execution_id", "commit_id", "error")
    finished = finished.filter(F.col("error").isNull())
    named = runs.join(finished.select("execution_id").distinct(), "execution_id", "left_semi").select("commit_id")
    commits = kept(finished.select("commit_id").unionByName(named).distinct())
    mine = kept(run_status_apply(runs.join(commits, "commit_id", "left_semi").select(runs.columns), finished))
    after = rollback_on_failure(mine, finished, known_deps, limit)
    rest = runs.join(commits, "commit_id", "left_anti").select(RUN_COLUMNS)
    rows = rest.unionByName(kept(after.runs))
    lists = cut(after.stack.long_deps(limit))
    deps = known_deps if limit is None else lists if known_deps is None else known_deps.unionByName(lists)
    started = start_ready(rows, deps=deps)
    errors = after.errors.unionByName(unread)
    return Advance(started.runs, started.inputs, errors, finished_statuses(finished), lists)


class Started(NamedTuple):
    inputs: DataFrame
    runs: DataFrame


def start_ready(runs: DataFrame, strict: bool = False, deps: DataFrame | None = None) -> Started:
    """The ready runs as JSON inputs, and the runs with those set to running."""
    ready = kept(ready_frontier(runs, strict, deps).select(
        "execution_id", F.lit("running").alias("status")
    ))
    after = keyed_update(runs, ready)
    # Whole rows are moved only if they wait, or have a ready run's id without waiting, which is rare.
    waits = F.col("status").eqNullSafe("waiting")
    shared = ready.select("execution_id").join(runs.filter(~waits).select("execution_id"), "execution_id", "left_semi")
    shared = measured(shared.distinct())
    begun = runs.filter(waits)
    if not shared.isEmpty():
        begun = begun.unionByName(runs.filter(~waits).join(shared, "execution_id", "left_semi").select(runs.columns))
    begun = begun.drop("status").join(ready, "execution_id")
    if deps is not None:
        # An input is one document and holds its run's whole list.
        long = deps.join(ready, "execution_id", "left_semi").groupBy("execution_id").agg(
            F.array_sort(F.collect_list("dep_path")).alias("_long")
        )
        begun = begun.join(long, "execution_id", "left").withColumn(
            "cfg_deps", F.coalesce("cfg_deps", "_long")
        )
    inputs = (
        begun
        .select(
            "execution_id",
            F.to_json(F.struct(*RUN_COLUMNS), {"ignoreNullFields": "false"}).alias("input_json"),
        )
    )
    return Started(inputs, after)
