"""Schemas and fixed vocabularies of the rollout data model."""

from pyspark.sql import types as T

_TEXTS = T.ArrayType(T.StringType())

# One row per (changed directory, deploy or rollback attempt).
RUN_SCHEMA = T.StructType(
    [
        T.StructField("execution_id", T.StringType()),
        T.StructField("is_rollback", T.BooleanType()),
        T.StructField("pr_id", T.IntegerType()),
        T.StructField("commit_id", T.StringType()),
        T.StructField("base_ref", T.StringType()),
        T.StructField("head_ref", T.StringType()),
        T.StructField("cfg_path", T.StringType()),
        T.StructField("cfg_deps", _TEXTS),
        T.StructField("status", T.StringType()),
        T.StructField("plan_command", T.StringType()),
        T.StructField("apply_command", T.StringType()),
        T.StructField("new_providers", _TEXTS),
        T.StructField("new_resources", _TEXTS),
        T.StructField("account_name", T.StringType()),
        T.StructField("account_path", T.StringType()),
        T.StructField("account_deps", _TEXTS),
        T.StructField("voters", _TEXTS),
        T.StructField("approval_voters", _TEXTS),
        T.StructField("min_approval_count", T.IntegerType()),
        T.StructField("rejection_voters", _TEXTS),
        T.StructField("min_rejection_count", T.IntegerType()),
        T.StructField("plan_role_arn", T.StringType()),
        T.StructField("apply_role_arn", T.StringType()),
    ]
)

DIM_SCHEMA = T.StructType(
    [
        T.StructField("account_name", T.StringType()),
        T.StructField("account_path", T.StringType()),
        T.StructField("account_deps", _TEXTS),
        T.StructField("min_approval_count", T.IntegerType()),
        T.StructField("min_rejection_count", T.IntegerType()),
        T.StructField("voters", _TEXTS),
        T.StructField("plan_role_arn", T.StringType()),
        T.StructField("apply_role_arn", T.StringType()),
    ]
)

RUN_COLUMNS = RUN_SCHEMA.fieldNames()
DIM_COLUMNS = DIM_SCHEMA.fieldNames()

# Fixed values.
IN_PROGRESS = ("waiting", "running")
BLOCKING = ("waiting", "running", "aborted", "failed")
BROKEN = ("failed", "aborted")
FINISHED_EVENTS = ("SUCCEEDED", "FAILED", "ABORTED")
SCAN_STATUSES = ("added", "modified", "removed")
OPEN_STATUSES = ("added", "modified")
CONFIG_SUFFIXES = (".hcl", ".tf")
FILE_PATH_PATTERN = r".+\.(hcl|tf)$"
ACTIONS = ("approve", "reject")
UNLOCKED = "none"

# Texts shown to users.
BAD_SIGNATURE_KIND = "Signature is not a valid sha256 value"
BAD_SIGNATURE = "Header signature and expected signature do not match"
NOT_A_PULL_REQUEST = "Event is not a pull request"
NO_PATH_MATCH = "No diff filepath was matched within pattern: "
REQUEST_OK = "Request was successful"
NOT_FOUND = "Not Found"
LOCKED_TEXT = "Locked -- In Progress PR #"
RUN_STATUS_TEXT = "Step Function Execution"
UNLOCKED_TEXT = "Unlocked"
VOTE_OK = "Vote was successfully submitted"
BAD_ACTION = "action is not approve or reject"
UNKNOWN_RUN = "run is unknown"
VOTE_EXPIRED = "Approval submissions are not available anymore -- Execution Status: "
MAIL_OK = "All emails were successfully sent"
MAIL_FAILED = " emails failed to send"
ROLLBACK_FAILED = (
    "Rollback execution failed -- User with administrative privileges"
    " will need to manually fix configuration"
)
UNKNOWN_STATUS = "status is unknown: "
PLAN_CONTEXT = "Plan: "

# Event source and detail type of finished runs.
RUN_EVENT_SOURCE = "aws.states"
RUN_EVENT_TYPE = "Step Functions Execution Status Change"

# The states of one run, in the order in which they can be entered.
STATES = ("Plan", "Request Approval", "Approval Results", "Apply", "Success", "Reject")

# Run id prefixes and command texts.
DEPLOY_ID = "run-"
ROLLBACK_ID = "run-rollback-"
WORK_DIR_FLAG = " --terragrunt-working-dir "
ROLE_FLAG = " --terragrunt-iam-role "
PLAN_TAIL = " -no-color"
APPLY_TAIL = " -no-color -auto-approve"
DESTROY_PLAN_TAIL = " -no-color -destroy"
