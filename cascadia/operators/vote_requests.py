"""Vote requests: what a voter's link sends, checked before it counts as a vote."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cascadia.functions.text import hmac_sha256, link_decode
from cascadia.model import (
    ACTIONS,
    BAD_ACTION,
    BAD_SIGNATURE,
    BAD_SIGNATURE_KIND,
    UNKNOWN_RUN,
    VOTE_EXPIRED,
    VOTE_OK,
)

# Parameters of a link and the columns they become.
_PARAMETERS = {
    "ex": "execution_id",
    "recipient": "voter",
    "action": "action",
    "exArn": "execution_arn",
    "taskToken": "task_token",
    "X-SES-Signature-256": "signature",
}
_SIGNED = ("execution_id", "voter", "action", "signature")


def vote_scan(requests: DataFrame, secret: str) -> DataFrame:
    """Decoded parameters of ``vote_id, ts, query`` and whether their signature holds.

    ``query`` is the part of the link after ``?``. ``missing`` names absent or undecodable
    parameters; ``sig_error`` is NULL when the signature over run, voter and action is right.
    Unknown parameters are ignored; of a repeated one the last counts.
    """
    pairs = F.transform(F.split("query", "&"), lambda p: F.split(p, "=", 2))

    def last(name: str):
        named = F.filter(pairs, lambda p: p[0] == name)
        return F.try_element_at(F.try_element_at(named, F.lit(-1)), F.lit(2))

    fields = requests.select(
        "vote_id", "ts", *[link_decode(last(name)).alias(column) for name, column in _PARAMETERS.items()]
    )
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(n)) for n, c in _PARAMETERS.items()])
    # The voter's address is decoded once more before it is signed, as the links have it.
    voter = F.coalesce(link_decode(F.col("voter")), F.col("voter"))
    expected = hmac_sha256(secret, F.concat(F.col("execution_id"), voter, F.col("action")))
    prefixed = F.col("signature").startswith("sha256=")
    same = F.substring_index("signature", "=", -1) == expected
    return fields.withColumns(
        {
            "missing": F.when(missing != "", missing),
            "sig_error": F.when(~prefixed, F.lit(BAD_SIGNATURE_KIND)).when(~same, F.lit(BAD_SIGNATURE)),
        }
    )


def vote_outcome(scanned: DataFrame, live: DataFrame) -> DataFrame:
    """Status code and message of every scanned request; ``accepted`` for those that vote.

    ``live`` is ``execution_arn, status``, one row per run. In this order: a signed
    parameter is missing (400), the signature is wrong (403), the run isn't running any more
    (410), anything else is missing or no known action (400), the run is unknown (400).
    """
    state = live.select("execution_arn", F.col("status").alias("_live"))
    unsigned = F.col("execution_id").isNull()
    for column in _SIGNED[1:]:
        unsigned = unsigned | F.col(column).isNull()
    absent = F.concat(F.lit("missing: "), F.col("missing"))
    rules = [
        (unsigned, 400, absent),
        (F.col("sig_error").isNotNull(), 403, F.col("sig_error")),
        (F.col("_live") != "RUNNING", 410, F.concat(F.lit(VOTE_EXPIRED), F.col("_live"))),
        (F.col("missing").isNotNull(), 400, absent),
        (~F.col("action").isin(*ACTIONS), 400, F.lit(BAD_ACTION)),
        (F.col("_live").isNull(), 400, F.lit(UNKNOWN_RUN)),
    ]
    code, message = F.lit(200), F.lit(VOTE_OK)
    for condition, number, text in reversed(rules):
        code = F.when(condition, number).otherwise(code)
        message = F.when(condition, text).otherwise(message)
    return scanned.join(state, "execution_arn", "left").select(
        "vote_id",
        "ts",
        "execution_id",
        "voter",
        "action",
        code.alias("status_code"),
        message.alias("message"),
        (code == 200).alias("accepted"),
    )


def accepted_votes(outcome: DataFrame) -> DataFrame:
    """The votes among the requests, as the vote operators and the vote stream take them."""
    return outcome.filter("accepted").select("vote_id", "ts", "execution_id", "voter", "action")
