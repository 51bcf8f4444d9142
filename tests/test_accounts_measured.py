"""Few accounts meet the files where these lie; many are joined by shuffles, with the same rows."""

import pytest

from cascadia import session
from cascadia.operators import filters as FL
from cascadia.operators import joins as J


@pytest.mark.parametrize("small", [True, False])
def test_prefixes_are_not_shuffled_for_few_accounts(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(session, "SMALL", -1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # Accounts nest, two share a path, one has none.
        dim = spark.createDataFrame(
            [("a", "live/a"), ("b", "live/a/b"), ("twin", "live/a"), ("none", None)], "account_name string, account_path string"
        )
        files = spark.createDataFrame(
            [(1, "c", "live/a/b/x/f.tf", "added"), (1, "c", "live/a/g.hcl", "removed"), (2, None, "live/z/f.tf", "added"), (2, None, None, "added")],
            "pr_id long, commit_id string, filename string, status string",
        )
        found = J.account_file_join(dim, files)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert ("Exchange hashpartitioning(_depth" not in plan) == small
        got = sorted((r.filename, r.account_name) for r in found.collect())
        assert got == [
            ("live/a/b/x/f.tf", "a"), ("live/a/b/x/f.tf", "b"), ("live/a/b/x/f.tf", "twin"),
            ("live/a/g.hcl", "a"), ("live/a/g.hcl", "twin"),
        ]
        dirs = sorted((r.account_name, r.dir) for r in FL.config_file_filter(files, dim).collect())
        assert dirs == [("a", "live/a"), ("a", "live/a/b/x"), ("b", "live/a/b/x"), ("twin", "live/a"), ("twin", "live/a/b/x")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
