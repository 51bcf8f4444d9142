"""Event streams: webhooks, finished runs, votes, steps, stack builds.

Finished runs change a table in place (:class:`LiveTable`), votes and steps live in Spark's keyed
state, and the other forms run the batch operators on each micro-batch.
"""

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from cascadia.model import FILE_PATH_PATTERN, RUN_COLUMNS
from cascadia.operators.filters import run_event_filter
from cascadia.operators.lifecycle import advance, lock_values, step_outcome, webhook_jobs
from cascadia.operators.vote_requests import vote_outcome, vote_scan
from cascadia.operators.votes import Tally
from cascadia.session import cut
from cascadia.sources.events import run_event_scan
from cascadia.streaming.tables import LiveTable
from cascadia.streaming.vote_state import counted_votes


def _put(df: DataFrame, folder: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{folder}/batch={batch_id:012d}")


def webhook_stream(
    events: DataFrame,
    files: DataFrame,
    dim: DataFrame,
    secret: str,
    out: str,
    pattern: str = FILE_PATH_PATTERN,
) -> DataStreamWriter:
    """Outcome, plan jobs and stack jobs of each micro-batch, under ``out``."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        # Three sinks read the batch, so its rows are stored once.
        jobs = webhook_jobs(cut(batch), files, dim, secret, pattern)
        for name, table in jobs._asdict().items():
            _put(table, f"{out}/{name}", batch_id)

    return events.writeStream.foreachBatch(apply)


def run_event_stream(events: DataFrame, table: LiveTable, out: str) -> DataStreamWriter:
    """Apply finished-run events: status, abort, rollback, then start what became ready.

    ``table`` holds the runs by ``commit_id``, so all a commit's rows are in one bucket. Start
    inputs, commit statuses and failed rollbacks go to ``out``, by batch.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        finished = cut(run_event_scan(run_event_filter(batch)))
        runs = cut(table.found_by(batch_id, finished))
        after = advance(runs, finished)
        rows = cut(after.runs.select(RUN_COLUMNS))
        _put(after.inputs, f"{out}/inputs", batch_id)
        _put(after.statuses, f"{out}/statuses", batch_id)
        _put(after.errors, f"{out}/errors", batch_id)
        table.replace(rows)

    return events.writeStream.foreachBatch(apply)


def vote_stream(
    votes: DataFrame, start: Tally, out: str, late: str = "1 day", keep: timedelta = timedelta(days=7)
) -> DataStreamWriter:
    """Decide runs as votes arrive; each vote comes out once, with its verdict (see ``counted_votes``)."""
    return counted_votes(votes, start, late, keep).writeStream.format("parquet").option("path", out)


def vote_request_stream(
    requests: DataFrame, runs: DataFrame, secret: str, out: str
) -> DataStreamWriter:
    """Outcome of every vote request of each micro-batch, under ``out``; ``runs`` as ``vote_outcome`` takes them."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        _put(vote_outcome(vote_scan(batch, secret), runs), f"{out}/outcomes", batch_id)

    return requests.writeStream.foreachBatch(apply)


def step_stream(steps: DataFrame, out: str, longest: str = "1 day") -> DataStreamWriter:
    """Path and status of every run a micro-batch had steps of, under ``out``; the last batch holds.

    ``steps`` has ``started``, when its run began. Steps may come in any order and again. A run
    closes, and its state goes, when another has started ``longest`` after it.
    """
    timed = steps.withColumn("started", F.col("started").cast("timestamp")).withWatermark("started", longest)
    paths = step_outcome(timed, ["execution_id", "started"])

    def apply(batch: DataFrame, batch_id: int) -> None:
        _put(batch, f"{out}/runs", batch_id)

    return paths.writeStream.outputMode("update").foreachBatch(apply)


def lock_stream(
    builds: DataFrame, runs: Callable[[], DataFrame], out: str
) -> DataStreamWriter:
    """Merge lock per repository after each micro-batch of stack builds.

    The state is one row per repository: its last build. ``runs`` gives the current runs.
    """
    last = builds.groupBy("repo").agg(
        F.max_by(F.struct("pr_id", "state"), F.struct("ts", "pr_id")).alias("_b")
    )

    def apply(batch: DataFrame, batch_id: int) -> None:
        _put(lock_values(batch, runs()), f"{out}/locks", batch_id)

    return last.writeStream.outputMode("complete").foreachBatch(apply)
