"""Projections, filters and per-row predicates."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascadia import model as M
from cascadia.functions.paths import config_dirs, under_accounts
from cascadia.functions.text import hmac_sha256
from cascadia.model import (
    BROKEN,
    FILE_PATH_PATTERN,
    FINISHED_EVENTS,
    IN_PROGRESS,
    SCAN_STATUSES,
    UNLOCKED,
)


def config_file_filter(files: DataFrame, dim: DataFrame, statuses=SCAN_STATUSES) -> DataFrame:
    """``commit_id, account_name, dir`` of changed configuration directories under an account.

    Files shrink to distinct directories before the account join.
    """
    dirs = config_dirs(files, ["commit_id"], statuses)
    return under_accounts(dirs, dim, F.col("dir")).select("commit_id", "account_name", "dir")


def pr_path_gate(files: DataFrame, pattern: str = FILE_PATH_PATTERN) -> DataFrame:
    """``repo, pr_id, matched``: whether any changed file, whatever its status, matches the pattern."""
    return files.groupBy("repo", "pr_id").agg(F.bool_or(F.col("filename").rlike(pattern)).alias("matched"))


def status_toggle(statuses: DataFrame, config: Column, strict: bool = False) -> DataFrame:
    """Statuses whose component is switched on in the configuration map.

    A missing component is off; under ``strict`` it is an error.
    """
    switch = F.try_element_at(config, F.col("component"))
    if strict:
        switch = F.when(
            switch.isNull(),
            F.raise_error(F.concat(F.lit("no status switch for "), F.col("component"))).cast(
                "boolean"
            ),
        ).otherwise(switch)
    return statuses.filter(F.coalesce(switch, F.lit(False)))


def webhook_route(events: DataFrame) -> DataFrame:
    """Add ``route``: ``open``, ``merge`` or NULL for an event nothing handles."""
    opened = F.col("action").isin("opened", "edited", "reopened") & (F.col("merged") == False)  # noqa: E712
    merged = (F.col("action") == "closed") & F.col("merged")
    return events.withColumn("route", F.when(opened, F.lit("open")).when(merged, F.lit("merge")))


def run_event_filter(
    events: DataFrame,
    source: str = M.RUN_EVENT_SOURCE,
    detail_type: str = M.RUN_EVENT_TYPE,
) -> DataFrame:
    """Finished-run events of the one source; a timed-out run is not among the statuses."""
    return events.filter(
        (F.col("source") == source)
        & (F.col("detail_type") == detail_type)
        & F.col("status").isin(*FINISHED_EVENTS)
    )


def commit_state(runs: DataFrame, *more: str) -> DataFrame:
    return runs.select(
        *more,
        "execution_id",
        "commit_id",
        F.when(F.col("status").isin(*BROKEN), "failure").otherwise("success").alias("state"),
    )


def abort_scope(runs: DataFrame, failed_commits: DataFrame) -> DataFrame:
    """Deploy runs still in progress in a failed commit."""
    return (
        runs.filter(F.col("status").isin(*IN_PROGRESS) & ~F.col("is_rollback"))
        .join(failed_commits.select("commit_id"), "commit_id", "left_semi")
        .select("execution_id")
    )


def lock_status(locks: DataFrame, prs: DataFrame) -> DataFrame:
    """Commit status that shows each open PR head the merge lock of its repository."""
    free = F.col("lock_value") == UNLOCKED
    return prs.join(locks, "repo").select(
        "repo",
        "head_ref",
        F.when(free, "success").otherwise("pending").alias("state"),
        F.when(free, F.lit(M.UNLOCKED_TEXT))
        .otherwise(F.concat(F.lit(M.LOCKED_TEXT), F.col("lock_value")))
        .alias("description"),
    )


def diff_text(text: Column) -> Column:
    """Plan text with each line marker moved to the first blank before it, and ``~`` as ``!``."""
    moved = F.regexp_replace(text, r"(?mdU)^([^\S ]*) (\s*)([+\-~])", "$1$3$2 ")
    return F.regexp_replace(moved, r"(?mdU)^([^\S ]*)~", "$1!")


def plan_change_summary(plans: DataFrame) -> DataFrame:
    """Diff block and the counts of added, changed and destroyed lines per plan."""
    counts = {"n_add": r"\+", "n_change": "!", "n_destroy": "-"}
    return plans.select("execution_id", diff_text(F.col("text")).alias("_diff")).select(
        "execution_id",
        F.concat(F.lit("\n``` diff\n"), F.col("_diff"), F.lit("\n```\n")).alias("diff"),
        *[
            F.regexp_count("_diff", F.lit(rf"(?mdU)^[^\S \n]*{marker}")).alias(name)
            for name, marker in counts.items()
        ],
    )


def signature_check(events: DataFrame, secret: str) -> DataFrame:
    """Add ``sig_ok`` and ``sig_error`` from the body's signature header."""
    header = F.coalesce(F.col("headers").getField("x-hub-signature-256"), F.lit("None"))
    prefixed = header.startswith("sha256=")
    # Everything after the first "=" must be the digest.
    same = F.substring(header, 8, 2**31 - 1) == hmac_sha256(secret, F.col("body"))
    error = F.when(~prefixed, F.lit(M.BAD_SIGNATURE_KIND)).when(
        ~same, F.lit(M.BAD_SIGNATURE)
    )
    return events.withColumn("sig_error", error).withColumn("sig_ok", F.col("sig_error").isNull())


def webhook_outcome(
    events: DataFrame, files: DataFrame, pattern: str = FILE_PATH_PATTERN
) -> DataFrame:
    """Status code and message per event, from scanned, routed and signature-checked events.

    ``files`` is ``repo, pr_id, filename, …``: numbers repeat across repositories. Only the
    files of the events' PRs are looked at, and they contribute the distinct PRs with a match.
    """
    asked = events.select("repo", F.col("number").alias("pr_id")).distinct()
    matching = (
        files.join(asked, ["repo", "pr_id"], "left_semi")
        .filter(F.col("filename").rlike(pattern))
        .select("repo", F.col("pr_id").alias("number"), F.lit(True).alias("_matched"))
        .distinct()
    )
    joined = events.join(matching, ["repo", "number"], "left")
    unmatched = F.col("body_error").isNull() & F.col("_matched").isNull()
    code = (
        F.when(~F.col("is_json"), 500)
        .when(F.col("route").isNull(), 404)
        .when(~F.col("sig_ok"), 403)
        .when(unmatched, 200)
        .when(F.col("parse_error").isNotNull(), 400)
        .otherwise(200)
    )
    message = (
        F.when(~F.col("is_json"), F.col("parse_error"))
        .when(F.col("route").isNull(), F.lit(M.NOT_FOUND))
        .when(~F.col("sig_ok"), F.col("sig_error"))
        .when(
            unmatched,
            F.lit(M.NO_PATH_MATCH + pattern),
        )
        .when(F.col("parse_error").isNotNull(), F.col("parse_error"))
        .otherwise(F.lit(M.REQUEST_OK))
    )
    return joined.select(
        *events.columns,
        code.alias("status_code"),
        message.alias("message"),
        ((code == 200) & F.col("_matched").isNotNull()).alias("accepted"),
    )


def voter_directory(dim: DataFrame) -> DataFrame:
    """Every account's voters in one list, repeats kept."""
    return dim.select(F.explode("voters").alias("voter"), "account_name")
