"""Typed reads of webhook and run-finished events."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascadia.model import NOT_A_PULL_REQUEST

_REF = "struct<sha:string,ref:string>"
_WEBHOOK = (
    "struct<action:string,repository:struct<full_name:string>,"
    f"pull_request:struct<merged:boolean,number:string,base:{_REF},head:{_REF}>>"
)
_RUN = "execution_id string, status string, is_rollback boolean, commit_id string, cfg_path string"

# Required fields in the order in which they are reported.
_REQUIRED = ("repo", "merged", "base_sha", "base_ref", "head_sha", "head_ref", "number", "action")


def _parsed(raw: DataFrame, document: Column, name: str) -> DataFrame:
    """Add a parsed document that later filters and joins cannot make Spark parse again.

    A filter on a field would be pushed below a plain projection, parser included; it is
    not pushed below the expansion of a one-element array.
    """
    return raw.select("*", F.explode(F.array(document)).alias(name))


def webhook_scan(raw: DataFrame) -> DataFrame:
    """Parse ``event_id, ts, headers, body``; unknown fields are ignored, missing ones reported.

    ``parse_error`` is NULL for a valid event, else names what is wrong with the headers
    or, as ``body_error`` does alone, with the body. ``is_json`` tells a body that is no
    JSON object from one that lacks fields.
    """
    # Wrapping the text makes a malformed body come out as a NULL event.
    wrapped = F.from_json(F.concat(F.lit('{"event":'), F.col("body"), F.lit("}")), f"event {_WEBHOOK}")
    parsed = _parsed(raw, wrapped, "_w").withColumn("_e", F.col("_w.event"))
    request = F.col("_e.pull_request")
    fields = parsed.select(
        *raw.columns,
        F.col("_e.repository.full_name").alias("repo"),
        F.col("_e.action").alias("action"),
        # Only the JSON values true and false count, no text that looks like them.
        request.getField("merged").alias("merged"),
        request.getField("number").try_cast("bigint").alias("number"),
        request.getField("base").getField("ref").alias("base_ref"),
        request.getField("base").getField("sha").alias("base_sha"),
        request.getField("head").getField("ref").alias("head_ref"),
        request.getField("head").getField("sha").alias("head_sha"),
        F.col("_e").isNotNull().alias("is_json"),
    )
    missing = F.concat_ws(
        ",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in _REQUIRED]
    )
    kind = F.coalesce(F.col("headers").getField("x-github-event"), F.lit(""))
    body_error = F.when(~F.col("is_json"), F.lit("body is not a JSON object")).when(
        missing != "", F.concat(F.lit("missing: "), missing)
    )
    header_error = F.when(kind != "pull_request", F.lit(NOT_A_PULL_REQUEST))
    return fields.withColumn("body_error", body_error).withColumn(
        "parse_error", F.coalesce(header_error, F.col("body_error"))
    )


def run_event_scan(raw: DataFrame) -> DataFrame:
    """Finished-run events: the output if there is one, else the input with the event's status.

    ``error`` is NULL for a whole event, else says which fields are missing or that the
    document is no JSON object.
    """
    has_output = F.length("output") > 0
    # The text is chosen first, so each event is parsed once.
    chosen = F.when(has_output, F.col("output")).otherwise(F.col("input"))
    parsed = _parsed(raw, F.from_json(chosen, _RUN), "_run")
    fields = parsed.select(
        "event_id",
        "ts",
        F.col("_run.execution_id").alias("execution_id"),
        F.when(has_output, F.col("_run.status")).otherwise(F.lower("status")).alias("status"),
        F.col("_run.is_rollback").alias("is_rollback"),
        F.col("_run.commit_id").alias("commit_id"),
        F.col("_run.cfg_path").alias("cfg_path"),
    )
    needed = ("execution_id", "status", "is_rollback", "commit_id")
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in needed])
    empty = F.coalesce("execution_id", "commit_id", "cfg_path", F.col("is_rollback").cast("string")).isNull()
    return fields.withColumn(
        "error",
        F.when(empty, F.lit("run document is not a JSON object")).when(
            missing != "", F.concat(F.lit("missing: "), missing)
        ),
    )
