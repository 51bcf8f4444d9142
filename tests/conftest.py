import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cascadia.model import RUN_SCHEMA  # noqa: E402
from cascadia.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def make_runs(spark):
    """Run rows from partial dicts; lists default to empty, the rest to plain values."""
    lists = [f.name for f in RUN_SCHEMA if f.dataType.simpleString() == "array<string>"]
    plain = dict(
        is_rollback=False,
        pr_id=1,
        commit_id="c0ffee",
        base_ref="master",
        head_ref="feature",
        status="waiting",
        account_name="dev",
        account_path="dev",
        min_approval_count=1,
        min_rejection_count=1,
        plan_role_arn="plan-arn",
        apply_role_arn="apply-arn",
    )

    def build(*rows):
        full = [{**{n: [] for n in lists}, **plain, **row} for row in rows]
        names = RUN_SCHEMA.fieldNames()
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in full], RUN_SCHEMA)

    return build
