"""Aggregates over runs, statuses, metrics and logs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cascadia.functions.lists import PAGE_ROWS, ordered_pages, paged_list
from cascadia.functions.ordered import numbered, running_steps
from cascadia.functions.paths import config_dirs
from cascadia.model import IN_PROGRESS, MAIL_FAILED, MAIL_OK, SCAN_STATUSES, UNKNOWN_STATUS


def changed_dirs(files: DataFrame) -> DataFrame:
    return config_dirs(files, ["commit_id"], SCAN_STATUSES)


def ready_ids(ready: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Ids of the ready runs per commit, in pages."""
    return paged_list(ready, ["commit_id", "is_rollback"], "execution_id", "execution_ids", page_rows)


def status_rollup(statuses: DataFrame) -> DataFrame:
    """One status per commit from ``commit_id, pos, status``, read in ``pos`` order.

    A running or waiting row decides, unless an unknown status comes before it, which is
    an error; then failed beats succeeded. No rows at all is an error too: a commit in
    the input whose only row has a NULL status.
    """
    known = F.col("status").isin("waiting", "running", "failed", "succeeded")
    facts = statuses.groupBy("commit_id").agg(
        F.min(F.when(F.col("status").isin(*IN_PROGRESS), F.col("pos"))).alias("_running"),
        F.min(F.when(~known, F.struct("pos", "status"))).alias("_unknown"),
        F.count_if(F.col("status") == "failed").alias("_failed"),
        F.count_if(F.col("status") == "succeeded").alias("_succeeded"),
    )
    unknown_first = F.col("_unknown").isNotNull() & (
        F.col("_running").isNull() | (F.col("_unknown.pos") < F.col("_running"))
    )
    return facts.select(
        "commit_id",
        F.when(unknown_first, F.lit(None))
        .when(F.col("_running").isNotNull(), "running")
        .when(F.col("_failed") > 0, "failed")
        .when(F.col("_succeeded") > 0, "succeeded")
        .alias("status"),
        F.when(
            unknown_first, F.concat(F.lit(UNKNOWN_STATUS), F.col("_unknown.status"))
        )
        .when(
            F.col("_running").isNull() & (F.col("_failed") + F.col("_succeeded") == 0),
            F.lit("no status"),
        )
        .alias("error"),
    )


def in_progress(runs: DataFrame) -> DataFrame:
    return runs.groupBy("repo").agg(
        F.bool_or(F.col("status").isin(*IN_PROGRESS)).alias("in_progress")
    )


def run_counts(runs: DataFrame) -> DataFrame:
    return runs.groupBy("commit_id", "account_name", "status").agg(F.count(F.lit(1)).alias("n"))


def next_pr_id(runs: DataFrame, new: DataFrame, order: str, sequential: bool = False) -> DataFrame:
    """Number the rows without a PR on from the highest PR in use, in ``order``.

    All numbers given count as in use, or, if ``sequential``, those given before the row: then
    rows are numbered as if they came one by one.
    """
    rest = [c for c in new.columns if c != "pr_id"]
    pr_id = F.col("pr_id").cast("bigint")
    used = runs.select(pr_id.alias("pr_id"))
    if sequential:
        top = used.agg(F.coalesce(F.max("pr_id"), F.lit(0)).alias("_top"))
        one = F.when(pr_id.isNull(), 1).otherwise(0).cast("bigint")
        steps = running_steps(
            new.withColumns({"_given": pr_id, "_one": one}), [], [order], "_given", "_one", "_number", top.scalar()
        )
        return steps.select(*rest, F.coalesce("_given", "_number").cast("int").alias("pr_id"))
    used = used.unionByName(new.select(pr_id.alias("pr_id")))
    top = used.agg(F.coalesce(F.max("pr_id"), F.lit(0)).alias("_top"))
    given = new.filter(F.col("pr_id").isNotNull())
    unset = numbered(new.filter(F.col("pr_id").isNull()).select(rest), [order], "_n")
    made = unset.withColumn("pr_id", (F.col("_n") + top.scalar()).cast("int"))
    return given.select(*rest, "pr_id").unionByName(made.select(*rest, "pr_id"))


def delivery_failures(deliveries: DataFrame) -> DataFrame:
    failed, total = F.count_if(F.col("status") != "Success"), F.count(F.lit(1))
    counted = deliveries.groupBy("execution_id").agg(failed.alias("failed"), total.alias("total"))
    return counted.withColumn(
        "status_code", F.when(F.col("failed") > 0, 500).otherwise(200)
    ).withColumn(
        "message",
        F.when(
            F.col("failed") > 0,
            F.concat(
                F.col("failed").cast("string"),
                F.lit("/"),
                F.col("total").cast("string"),
                F.lit(MAIL_FAILED),
            ),
        ).otherwise(F.lit(MAIL_OK)),
    )


def commit_paths(runs: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Directories of the runs per commit, in pages."""
    return paged_list(runs, ["commit_id"], "cfg_path", "cfg_paths", page_rows)


def adjacency(nodes: DataFrame, edges: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Ordered dependencies of every directory, in pages; one empty list if there are none."""
    keys = ["graph_id", "cfg_path"]
    lists = ordered_pages(edges, keys, "pos", "dep_path", "deps", page_rows)
    return nodes.join(lists, keys, "left").select(
        *keys,
        F.coalesce("page", F.lit(0).cast("bigint")).alias("page"),
        F.coalesce(F.col("deps"), F.array().cast("array<string>")).alias("deps"),
    )


def waiting_commits(runs: DataFrame, repo: str | None = None) -> DataFrame:
    """Distinct waiting ``(commit_id, is_rollback)``; ``conflict`` if there is more than one.

    With ``repo``, a column of ``runs``, they are counted within each repository.
    """
    scope = [] if repo is None else [repo]
    waiting = runs.filter(F.col("status") == "waiting").select(*scope, "commit_id", "is_rollback").distinct()
    n = F.count(F.lit(1)).alias("n")
    if repo is None:
        return waiting.withColumn("conflict", waiting.agg(n).scalar() > 1)
    return waiting.join(waiting.groupBy(repo).agg(n), repo).select(*waiting.columns, (F.col("n") > 1).alias("conflict"))


def required_status_count(
    statuses: DataFrame, expected: DataFrame, lock_context: str = "merge lock"
) -> DataFrame:
    """Expected, found and finished plan statuses per head commit, the lock's own left out."""
    found = (
        statuses.filter(F.col("context") != lock_context)
        .groupBy("commit_id")
        .agg(
            F.count(F.lit(1)).alias("_found"),
            F.count_if(F.col("state") != "pending").alias("_finished"),
        )
    )
    return expected.join(found, "commit_id", "left").select(
        "commit_id",
        "expected",
        F.coalesce("_found", F.lit(0)).alias("found"),
        F.coalesce("_finished", F.lit(0)).alias("finished"),
    )


def invocation_count(datapoints: DataFrame, start, end) -> DataFrame:
    """Number of metric points per function in ``[start, end)``; the sampled values are not added."""
    return (
        datapoints.filter((F.col("ts") >= start) & (F.col("ts") < end))
        .groupBy("function_name")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def preceding_event(events: DataFrame) -> DataFrame:
    """Type of the event right before a state's exit event, by id.

    An equality join on ``id - 1``: no group is ever ordered as a whole.
    """
    exits = events.filter(F.col("type").endswith("StateExited")).select(
        "execution_id", (F.col("id") - 1).alias("id"), "state"
    )
    before = events.select("execution_id", "id", F.col("type").alias("status_type"))
    return exits.join(before, ["execution_id", "id"]).select(
        "execution_id", "state", "status_type"
    )


def latest_status(statuses: DataFrame) -> DataFrame:
    """Newest status per commit and context."""
    rest = [c for c in statuses.columns if c not in ("commit_id", "context")]
    return (
        statuses.groupBy("commit_id", "context")
        .agg(F.max_by(F.struct(*rest), F.struct("ts", "status_id")).alias("_s"))
        .select("commit_id", "context", "_s.*")
    )


def latest_stream_errors(
    log_events: DataFrame, word: str = "ERROR", start=None, end=None
) -> DataFrame:
    """Events with ``word`` in the stream of each log group that has the newest event."""
    newest = log_events.groupBy("log_group").agg(
        F.max_by("stream", F.struct("ts", "event_id")).alias("stream")
    )
    wanted = log_events.filter(F.col("message").contains(word))
    if start is not None and end is not None:
        wanted = wanted.filter((F.col("ts") >= start) & (F.col("ts") <= end))
    return wanted.join(newest, ["log_group", "stream"], "left_semi")
