"""Streams over files give what the batch operators give."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from cascadia.model import RUN_SCHEMA
from cascadia.operators.filters import run_event_filter
from cascadia.operators.lifecycle import advance, merge_lock, step_outcome, webhook_jobs
from cascadia.operators.vote_requests import accepted_votes, vote_outcome, vote_scan
from cascadia.operators.votes import late_votes, tally_of, vote_decision
from cascadia.plans import frames
from cascadia.plans.queries import _live, _vote_requests
from cascadia.plans.views import SECRET, Tables
from cascadia.sources.events import run_event_scan
from cascadia.streaming.streams import (
    lock_stream,
    run_event_stream,
    step_stream,
    vote_request_stream,
    vote_stream,
    webhook_stream,
)
from cascadia.streaming.tables import LiveTable
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SMALL)


def source(spark, df, folder, parts, order=None):
    """``df`` as files, one micro-batch each; later rows in later files if ``order`` is given."""
    if order:
        cuts = df.approxQuantile(order, [i / parts for i in range(1, parts)], 0.01)
        for low, high in zip([None, *cuts], [*cuts, None], strict=True):
            part = df if low is None else df.filter(F.col(order) >= low)
            part = part if high is None else part.filter(F.col(order) < high)
            part.coalesce(1).write.mode("append").parquet(folder)
    else:
        df.repartition(parts).write.parquet(folder)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
    return stream.parquet(folder)


def drain(writer, checkpoint):
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None
    return query


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def schema(text) -> StructType:
    return _parse_datatype_string(text)


def test_webhooks(spark, tables, tmp_path):
    raw, files, dim = frames.raw_webhooks(tables), tables["pr_file"], frames.dim(tables)
    writer = webhook_stream(source(spark, raw, f"{tmp_path}/in", 2), files, dim, SECRET, f"{tmp_path}/out")
    drain(writer, f"{tmp_path}/cp")
    batch = webhook_jobs(raw, files, dim, SECRET)
    for name, table in batch._asdict().items():
        got = spark.read.parquet(f"{tmp_path}/out/{name}").select(table.columns)
        assert rows(got) == rows(table), name


def parts_of(df, n):
    """``df`` in n parts by event, each a list of its rows."""
    return [df.where(F.pmod(F.xxhash64("event_id"), F.lit(n)) == i) for i in range(n)]


@pytest.fixture
def run_table(spark, tables, tmp_path):
    table = LiveTable(spark, f"{tmp_path}/runs", RUN_SCHEMA, "commit_id", 4)
    table.replace(frames.runs(tables))
    return table


def test_run_events(spark, tables, run_table, tmp_path):
    """Three micro-batches give what the batch operators give one after another."""
    events = tables["run_event_doc"]
    parts = parts_of(events, 3)
    for i, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        # One file a batch, in the order they were written.
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        drain(run_event_stream(stream, run_table, f"{tmp_path}/out"), f"{tmp_path}/cp")
    runs, inputs, statuses = frames.runs(tables), [], []
    names = ["execution_id", "status", "is_rollback", "cfg_path", "cfg_deps"]
    for part in parts:
        after = advance(runs, run_event_scan(run_event_filter(part)))
        touched = run_event_scan(run_event_filter(part)).select(F.pmod(F.xxhash64("commit_id"), F.lit(4)).alias("b")).distinct()
        started = after.inputs.join(after.runs.select("execution_id", F.pmod(F.xxhash64("commit_id"), F.lit(4)).alias("b")), "execution_id").join(touched, "b", "left_semi")
        assert started.count() == after.inputs.count()
        inputs += rows(after.inputs.select("execution_id", "input_json"))
        statuses += rows(after.statuses)
        runs = after.runs.checkpoint()
    assert rows(run_table.read().select(names)) == rows(runs.select(names))
    assert rows(spark.read.parquet(f"{tmp_path}/out/inputs").select("execution_id", "input_json")) == sorted(inputs)
    assert rows(spark.read.parquet(f"{tmp_path}/out/statuses").select("event_id", "commit_id", "context", "state", "description")) == sorted(statuses)


def test_a_batch_that_fails_runs_again(spark, tables, run_table, tmp_path, monkeypatch):
    """Whether the table was written before the failure or not, the second run gives the same."""
    events = tables["run_event_doc"]
    stream = source(spark, events, f"{tmp_path}/in", 1)
    names = ["execution_id", "status", "is_rollback", "cfg_path"]
    after = advance(frames.runs(tables), run_event_scan(run_event_filter(events)))
    replace = LiveTable.replace
    for moment in ("before", "after"):

        def fails(self, df, moment=moment):
            if moment == "after":
                replace(self, df)
            raise RuntimeError("lost")

        monkeypatch.setattr(LiveTable, "replace", fails)
        query = run_event_stream(stream, run_table, f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
        with pytest.raises(Exception, match="lost"):
            query.awaitTermination()
    monkeypatch.setattr(LiveTable, "replace", replace)
    drain(run_event_stream(stream, run_table, f"{tmp_path}/out"), f"{tmp_path}/cp")
    assert rows(run_table.read().select(names)) == rows(after.runs.select(names))
    assert rows(spark.read.parquet(f"{tmp_path}/out/inputs").select("execution_id", "input_json")) == rows(after.inputs)


def test_votes(spark, tables, tmp_path):
    """Five micro-batches with a restart between give what the batch operators give."""
    runs, votes = frames.vote_runs(tables), tables["vote"]
    parts, low = [], 0
    for high in votes.approxQuantile("vote_id", [0.2, 0.4, 0.6, 0.8, 1.0], 0.001):
        parts.append(votes.where(F.col("vote_id").between(low, int(high))))
        low = int(high) + 1
    for part in parts[:3], parts[3:]:
        for df in part:
            df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(votes.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        drain(vote_stream(stream, tally_of(runs), f"{tmp_path}/out", late="3650 days"), f"{tmp_path}/cp")
    got = spark.read.parquet(f"{tmp_path}/out")
    verdict, batch = late_votes(runs, votes), vote_decision(runs, votes)
    assert rows(got.select(verdict.columns)) == rows(verdict)
    assert rows(got.where("decides").select(batch.columns)) == rows(batch)


VOTES = "vote_id long, execution_id string, voter string, action string, ts timestamp"


def vote_batches(spark, tmp_path, batches, **settings):
    """Verdicts of votes given as lists, one micro-batch each, and the last query."""
    schema_ = schema(VOTES)
    run_columns = "execution_id string, approval_voters array<string>, rejection_voters array<string>, min_approval_count int, min_rejection_count int"
    runs = spark.createDataFrame([(f"r{i}", [], [], 2, 2) for i in range(60)], run_columns)
    sizes = []
    for batch in batches:
        spark.createDataFrame(batch, schema_).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema_).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        query = drain(vote_stream(stream, tally_of(runs), f"{tmp_path}/out", **settings), f"{tmp_path}/cp")
        last = query.lastProgress["stateOperators"]
        sizes.append({o["operatorName"]: o["numRowsTotal"] for o in last})
    return {r.vote_id: r.accepted for r in spark.read.parquet(f"{tmp_path}/out").collect()}, sizes


def test_votes_delivered_again_count_once(spark, tmp_path):
    at = datetime(2024, 1, 1)
    first = [(1, "r1", "a", "approve", at), (1, "r1", "a", "approve", at), (2, "r1", "b", "approve", at + timedelta(minutes=1))]
    again = [(1, "r1", "a", "approve", at), (2, "r1", "b", "approve", at + timedelta(minutes=1)), (3, "r1", "c", "approve", at + timedelta(minutes=2))]
    got, _ = vote_batches(spark, tmp_path, [first, again], late="1 hour")
    # The third comes after the decision, a vote on no known run never counts.
    assert got == {1: True, 2: True, 3: False}


def test_state_of_decided_runs_goes(spark, tmp_path):
    """Each batch decides its runs a day after those before it; what is kept levels off."""
    batches = []
    for day in range(6):
        at = datetime(2024, 1, 1) + timedelta(days=day)
        batch = []
        for i in range(10):
            for k, voter in enumerate("ab"):
                batch.append((100 * day + 2 * i + k, f"r{10 * day + i}", voter, "approve", at + timedelta(seconds=k)))
        batches.append(batch)
    batches.append([(9_000, "r3", "z", "approve", datetime(2024, 1, 6, 12))])
    got, sizes = vote_batches(spark, tmp_path, batches, late="1 hour", keep=timedelta(hours=2))
    assert all(accepted for vote, accepted in got.items() if vote < 9_000)
    # A vote on a run that was decided days ago finds no run any more.
    assert got[9_000] is False
    dedupe = [s["dedupeWithinWatermark"] for s in sizes]
    assert max(dedupe) <= 40
    counted = [s["transformWithStateInPandasExec"] for s in sizes]
    assert counted[-1] < counted[0]


def test_vote_requests(spark, tables, tmp_path):
    requests, live = _vote_requests(tables), _live(tables)
    writer = vote_request_stream(source(spark, requests, f"{tmp_path}/in", 2), live, SECRET, f"{tmp_path}/out")
    drain(writer, f"{tmp_path}/cp")
    batch = vote_outcome(vote_scan(requests, SECRET), live)
    got = spark.read.parquet(f"{tmp_path}/out/outcomes").select(batch.columns)
    assert rows(got) == rows(batch)
    assert rows(accepted_votes(got)) == rows(accepted_votes(batch))


def test_steps(spark, tables, tmp_path):
    """Steps in any order, some of them twice, over several batches."""
    steps = tables["step_event"].withColumn("started", F.lit(datetime(2024, 1, 1)).cast("timestamp"))
    rng = random.Random(4)
    some = steps.limit(3000).collect()
    some = some + rng.sample(some, 500)
    rng.shuffle(some)
    steps_schema = steps.schema
    for i in range(3):
        spark.createDataFrame(some[i::3], steps_schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(steps_schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    drain(step_stream(stream, f"{tmp_path}/out"), f"{tmp_path}/cp")
    got = spark.read.parquet(f"{tmp_path}/out/runs")
    last = got.groupBy("execution_id").agg(F.max_by(F.struct("path", "status"), "batch").alias("r"))
    batch = step_outcome(spark.createDataFrame(some, steps_schema))
    assert rows(last.select("execution_id", "r.path", "r.status")) == rows(batch)


def test_a_run_closes_when_others_start_much_later(spark, tmp_path):
    columns = "execution_id string, id long, type string, state string, output string, started timestamp"
    day = lambda d: datetime(2024, 1, d)
    batches = [
        [("old", 1, "TaskStateEntered", "Plan", "", day(1))],
        [("new", 1, "TaskStateEntered", "Plan", "", day(5))],
        [("new", 2, "TaskFailed", "Plan", "", day(5))],
        [("old", 2, "TaskFailed", "Plan", "", day(1))],
    ]
    sizes = []
    for batch in batches:
        spark.createDataFrame(batch, columns).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema(columns)).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        query = drain(step_stream(stream, f"{tmp_path}/out", longest="1 day"), f"{tmp_path}/cp")
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    last = spark.read.parquet(f"{tmp_path}/out/runs").groupBy("execution_id").agg(F.max_by("status", "batch").alias("status"))
    # The late step of the closed run is dropped, and its state is gone.
    assert {r.execution_id: r.status for r in last.collect()} == {"old": "running", "new": "failed"}
    assert sizes[-1] == 1


def test_locks(spark, tables, tmp_path):
    builds, runs = tables["build"], frames.repo_runs(tables)
    drain(lock_stream(source(spark, builds, f"{tmp_path}/in", 2), lambda: runs, f"{tmp_path}/out"), f"{tmp_path}/cp")
    got = spark.read.parquet(f"{tmp_path}/out/locks")
    newest = got.filter(F.col("batch") == got.agg(F.max("batch")).first()[0])
    batch = merge_lock(runs, builds)
    assert rows(newest.select(batch.columns)) == rows(batch)
