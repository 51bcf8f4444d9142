"""Which runs may start, kept up to date event by event.

For every commit four tables are kept: the gates of its runs (a directory or an account) with
how many pending runs each still has, who keeps which gate open, who waits for which gate, and
how many open gates each waiting run has. A run that succeeds leaves its gates; a gate that so
becomes empty is taken off the count of those that wait for it; a run without open gates may start.
All four lie in buckets by commit, and a batch of events reads and writes those of its commits.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from cascadia.operators.graph import pending_runs
from cascadia.session import cut
from cascadia.streaming.tables import LiveTable

_GATE = "gate struct<commit_id:string,is_rollback:boolean,kind:string,name:string>"
_TABLES = {
    "gates": f"commit_id string, {_GATE}, n bigint",
    "members": f"commit_id string, item string, {_GATE}",
    "needs": f"commit_id string, item string, {_GATE}",
    "waits": "commit_id string, item string, n bigint",
}


class Counts(NamedTuple):
    gates: DataFrame
    members: DataFrame
    needs: DataFrame
    waits: DataFrame


def open_counts(runs: DataFrame, deps: DataFrame | None = None) -> Counts:
    """The tables as a run table gives them."""
    pending, members, needs = pending_runs(runs, deps)
    commit = F.col("gate.commit_id").alias("commit_id")
    gates = members.groupBy("gate").agg(F.count(F.lit(1)).alias("n")).select(commit, "gate", "n")
    able = pending.filter((F.col("status") == "waiting") & ~F.col("stuck")).select("commit_id", "item")
    # A run without a known list never starts, so nothing is counted for it.
    needs = needs.distinct().join(gates.select("gate"), "gate", "left_semi").join(able.select("item"), "item", "left_semi")
    counted = needs.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    waits = able.join(counted, "item", "left").select("commit_id", "item", F.coalesce("n", F.lit(0)).alias("n"))
    return Counts(gates, members.select(commit, "item", "gate"), needs.select(commit, "item", "gate"), waits)


def after_events(before: Counts, events: DataFrame) -> Counts:
    """The tables after ``events`` (``commit_id, execution_id, status``).

    A run that is no longer waiting can't start; one that succeeded leaves its gates, once.
    """
    named = events.select(F.col("execution_id").alias("item")).distinct()
    done = events.filter("status = 'succeeded'").select(F.col("execution_id").alias("item")).distinct()
    left = cut(before.members.join(done, "item", "left_semi"))
    members = before.members.join(done, "item", "left_anti")
    gone = left.groupBy("gate").agg(F.count(F.lit(1)).alias("gone"))
    gates = cut(
        before.gates.join(gone, "gate", "left").select(
            "commit_id", "gate", (F.col("n") - F.coalesce("gone", F.lit(0))).alias("n"), F.col("gone").isNotNull().alias("touched")
        )
    )
    empty = gates.filter("touched AND n = 0").select("gate")
    opened = before.needs.join(empty, "gate", "left_semi").groupBy("item").agg(F.count(F.lit(1)).alias("opened"))
    waits = (
        before.waits.join(named, "item", "left_anti")
        .join(opened, "item", "left")
        .select("commit_id", "item", (F.col("n") - F.coalesce("opened", F.lit(0))).alias("n"))
    )
    return Counts(gates.select("commit_id", "gate", "n"), members, before.needs, waits)


class ReadyRuns:
    """The tables under a folder all executors share."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 256):
        self.tables = {
            name: LiveTable(spark, f"{path}/{name}", _parse_datatype_string(columns), "commit_id", buckets)
            for name, columns in _TABLES.items()
        }

    def create(self, runs: DataFrame, deps: DataFrame | None = None) -> None:
        """Start from a run table, in which some runs may be ready."""
        for name, rows in open_counts(runs, deps)._asdict().items():
            self.tables[name].replace(rows)

    def ready(self) -> DataFrame:
        """``commit_id, execution_id`` of all runs that may start."""
        return self.tables["waits"].read().filter("n = 0").select("commit_id", F.col("item").alias("execution_id"))

    def apply(self, batch_id: int, events: DataFrame) -> DataFrame:
        """Take in ``commit_id, execution_id, status``; returns the runs that so became ready.

        A batch that runs again gives and writes the same. Events may come twice.
        """
        events = cut(events.select("commit_id", "execution_id", "status"))
        before = Counts(**{n: cut(t.found_by(batch_id, events)) for n, t in self.tables.items()})
        after = after_events(before, events)
        waits = cut(after.waits)
        new = waits.filter("n = 0").join(before.waits.filter("n > 0").select("item"), "item", "left_semi")
        new = cut(new.select("commit_id", F.col("item").alias("execution_id")))
        for name, rows, old in (("gates", after.gates, before.gates), ("members", after.members, before.members), ("waits", waits, before.waits)):
            self.tables[name].replace_found(rows, old)
        return new
