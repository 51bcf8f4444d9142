"""Votes counted in Spark's keyed state, one key a run.

The state of a run is its minima, the two counts and, once it is decided, the deciding vote; and
a map of the voters on its lists. A decided run needs its voters no more, so they go at once;
the rest goes when the watermark has passed the decision by ``keep``. Later votes find no run,
and are not accepted, as before.
"""

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cascadia.operators.votes import Tally

VERDICT = (
    "vote_id bigint, execution_id string, action string, accepted boolean, decides boolean, "
    "n_approve bigint, n_reject bigint"
)
_COLUMNS = [c.split()[0] for c in VERDICT.split(", ")]
_RUN = "min_approval bigint, min_rejection bigint, n_approve bigint, n_reject bigint, decided_by bigint"
_SIDES = "approve boolean, reject boolean"


class VoteCounter(StatefulProcessor):
    def __init__(self, keep: timedelta):
        self.keep_ms = int(keep.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", _RUN)
        self.voters = handle.getMapState("voters", "voter string", _SIDES)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for row in initialState.itertuples():
            self.run.update(tuple(_number(x) for x in (row.min_approval, row.min_rejection, row.n_approve, row.n_reject)) + (None,))
            if row.voter is not None:
                self.voters.updateValue((row.voter,), (bool(row.approve), bool(row.reject)))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # The votes of one run in one micro-batch, in their order.
        votes = pd.concat(list(rows)).sort_values(["ts", "vote_id"])
        known = self.run.exists()
        least_a, least_r, n_a, n_r, decided = self.run.get() if known else (None,) * 5
        out = []
        for vote_id, voter, action, ts in zip(votes["vote_id"], votes["voter"], votes["action"], votes["ts"]):
            accepted = known and decided is None
            decides = False
            if accepted:
                had_a, had_r = self.voters.getValue((voter,)) if self.voters.containsKey((voter,)) else (False, False)
                approves, rejects = action == "approve", action == "reject"
                n_a = None if n_a is None else n_a + approves - had_a
                n_r = None if n_r is None else n_r + rejects - had_r
                self.voters.updateValue((voter,), (approves, rejects))
                decides = n_a is not None and n_r is not None and (n_a == least_a or n_r == least_r)
                if decides:
                    decided = vote_id
                    self.voters.clear()
                    self.handle.registerTimer(int(pd.Timestamp(ts).timestamp() * 1000) + self.keep_ms)
            out.append((vote_id, key[0], action, accepted, decides, n_a, n_r))
        if known:
            self.run.update((least_a, least_r, n_a, n_r, None if decided is None else int(decided)))
        frame = pd.DataFrame(out, columns=_COLUMNS)
        yield frame.astype({"n_approve": "Int64", "n_reject": "Int64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.run.clear()
        yield from ()

    def close(self) -> None:
        pass


def _number(x) -> int | None:
    return None if pd.isna(x) else int(x)


def counted_votes(
    votes: DataFrame, start: Tally, late: str = "1 day", keep: timedelta = timedelta(days=7)
) -> DataFrame:
    """Every vote of a stream with its verdict, and the deciding ones.

    ``votes`` is ``vote_id, execution_id, voter, action, ts``; ``start`` gives the runs and who is on
    their lists. A vote delivered again within ``late`` of event time counts once, and one that
    comes later than that is dropped. Columns are those of :data:`VERDICT`; the counts of the
    deciding vote are those of the decision.
    """
    members = start.members.select("execution_id", "voter", "approve", "reject")
    runs = start.runs.select(
        "execution_id",
        *[F.col(f"min_{s}_count").cast("bigint").alias(f"min_{s}") for s in ("approval", "rejection")],
        "n_approve",
        "n_reject",
    )
    first = runs.join(members, "execution_id", "left")
    timed = votes.withColumn("ts", F.col("ts").cast("timestamp"))
    once = timed.withWatermark("ts", late).dropDuplicatesWithinWatermark(["vote_id"])
    return once.groupBy("execution_id").transformWithStateInPandas(
        statefulProcessor=VoteCounter(keep),
        outputStructType=VERDICT,
        outputMode="Append",
        timeMode="EventTime",
        initialState=first.groupBy("execution_id"),
    )
