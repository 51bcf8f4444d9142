"""Vote requests as links make them, and tampered ones."""

import hashlib
import hmac
import urllib.parse

import pytest
from pyspark.sql import functions as F

from cascadia.operators.joins import voter_fanout
from cascadia.operators.vote_requests import accepted_votes, vote_outcome, vote_scan

SECRET = "ballot"


@pytest.fixture(scope="module")
def link(spark):
    """The query string of a link for one vote."""

    def build(run="run-9", voter="vera+1@quay.example", action="approve"):
        runs = spark.createDataFrame([(run, f"arn:{run}", "arn:m", "tok 1/=", [voter])], "execution_id string, execution_arn string, machine_arn string, task_token string, voters array<string>")
        return voter_fanout(runs, "https://x/", SECRET).filter(F.col("action") == action).first().url.split("?", 1)[1]

    return build


def outcome(spark, *queries):
    requests = spark.createDataFrame([(i, i, q) for i, q in enumerate(queries)], "vote_id int, ts int, query string")
    live = spark.createDataFrame([("arn:run-9", "RUNNING"), ("arn:run-old", "SUCCEEDED")], "execution_arn string, status string")
    return vote_outcome(vote_scan(requests, SECRET), live)


def test_codes(spark, link):
    good = link(voter="vera@quay.example")
    rows = outcome(
        spark,
        good,
        good.replace("action=approve", "action=reject"),
        good.replace("256=sha256", "256=md5"),
        link(run="run-old", voter="v"),
        link(run="run-gone", voter="v"),
        good.replace("&taskToken=", "&other="),
        good.replace("ex=run-9&", ""),
        None,
        "",
    )
    got = {r.vote_id: (r.status_code, r.message) for r in rows.collect()}
    assert got == {
        0: (200, "Vote was successfully submitted"),
        1: (403, "Header signature and expected signature do not match"),
        2: (403, "Signature is not a valid sha256 value"),
        3: (410, "Approval submissions are not available anymore -- Execution Status: SUCCEEDED"),
        4: (400, "run is unknown"),
        5: (400, "missing: taskToken"),
        6: (400, "missing: ex"),
        7: (400, "missing: ex,recipient,action,exArn,taskToken,X-SES-Signature-256"),
        8: (400, "missing: ex,recipient,action,exArn,taskToken,X-SES-Signature-256"),
    }
    votes = accepted_votes(rows).collect()
    assert [(v.vote_id, v.execution_id, v.voter, v.action) for v in votes] == [(0, "run-9", "vera@quay.example", "approve")]


def test_signed_but_unknown_action(spark):
    digest = hmac.new(SECRET.encode(), b"run-9vmaybe", hashlib.sha256).hexdigest()
    twice = lambda v: urllib.parse.quote_plus(urllib.parse.quote_plus(v)).replace("%", "$")
    query = "&".join(f"{k}={twice(v)}" for k, v in {"ex": "run-9", "recipient": "v", "action": "maybe", "exArn": "arn:run-9", "taskToken": "t", "X-SES-Signature-256": f"sha256={digest}"}.items())
    row = outcome(spark, query).first()
    assert (row.status_code, row.message, row.accepted) == (400, "action is not approve or reject", False)
