"""Account and run tables: scans, upsert, append, keyed update, checks."""

import uuid
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascadia.functions.text import brace_list, csv_list
from cascadia.model import DIM_COLUMNS, SCAN_STATUSES
from cascadia.session import cut


def account_upsert(dim: DataFrame, updates: DataFrame) -> DataFrame:
    """Insert or replace whole account rows; of a repeated key the highest ``seq`` wins.

    An update's NULL overwrites. The aggregate combines before the shuffle, so one account
    with very many updates costs one row per task.
    """
    rest = [c for c in DIM_COLUMNS if c != "account_name"]
    latest = (
        updates.groupBy("account_name")
        .agg(F.max_by(F.struct(*rest), F.col("seq")).alias("_row"))
        .select("account_name", "_row.*")
    )
    kept = dim.select(DIM_COLUMNS).join(latest, "account_name", "left_anti")
    return kept.select(DIM_COLUMNS).unionByName(latest.select(DIM_COLUMNS))


def account_scan(raw_dim: DataFrame) -> DataFrame:
    """Account table whose array columns arrive as ``{a,b}`` text, in name order."""
    return raw_dim.withColumns(
        {c: F.transform(brace_list(F.col(c)), lambda x: F.trim(x)) for c in ("account_deps", "voters")}
    ).orderBy("account_name")


def changed_file_scan(files: DataFrame, statuses: Iterable[str] | None = SCAN_STATUSES) -> DataFrame:
    """File listing restricted to change statuses; ``None`` keeps every status."""
    return files if statuses is None else files.filter(F.col("status").isin(list(statuses)))


def inline_stack(rows: DataFrame) -> DataFrame:
    """Stack relation ``cfg_path, cfg_deps, new_providers`` from comma-list text rows."""
    return rows.select(
        "cfg_path",
        csv_list(F.col("cfg_deps")).alias("cfg_deps"),
        csv_list(F.col("new_providers")).alias("new_providers"),
    )


def constraint_check(df: DataFrame, key: str, counts: Iterable[str] = ()) -> DataFrame:
    """Violations ``rule, key, n``: repeated keys, negative minimum counts, glob characters in paths."""
    repeated = (
        df.groupBy(F.col(key).alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(F.lit("unique_key").alias("rule"), "key", "n")
    )
    # One pass over the rows for all row-level rules.
    row_rules = [F.when(F.col(c) < 0, F.lit(f"negative_{c}")) for c in counts]
    if "account_path" in df.columns:
        row_rules.append(
            F.when(F.col("account_path").rlike(r"[*?\[]"), F.lit("glob_in_account_path"))
        )
    if not row_rules:
        return repeated
    broken = (
        df.select(F.col(key).alias("key"), F.array_compact(F.array(*row_rules)).alias("_rules"))
        .select("key", F.explode("_rules").alias("rule"))
        .groupBy("rule", "key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return repeated.unionByName(broken)


def stack_append(runs: DataFrame, new_runs: DataFrame) -> DataFrame:
    """Runs after one append of every account's new rows."""
    return runs.unionByName(new_runs.select(runs.columns))


def _manifest(path: str) -> str:
    return f"{path.rstrip('/')}-appends"


def read_stack(spark: SparkSession, path: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """Runs of all finished appends, of the given buckets; those of an append that died don't show."""
    rows = spark.read.parquet(path)
    if buckets is not None:
        rows = rows.where(F.col("bucket").isin(list(buckets)))
    done = spark.read.schema("commit_id string, append_id string").parquet(_manifest(path))
    return rows.join(done, ["commit_id", "append_id"], "left_semi").drop("append_id", "bucket")


def write_stack(new_runs: DataFrame, path: str, buckets: int = 64) -> DataFrame:
    """Append new runs to the run table: readers see all accounts of a commit, or none.

    Files are laid out by a hash of the commit, not by the commit itself, so a commit
    with very many runs is still one directory among few and small commits share files. Rows
    carry the id of their append, and one small file, written last, names the commits that are
    whole (:func:`read_stack`). A broken rule stops the write before any row lands. Runs that the
    commits' buckets have already are not written again, so a repeated write adds nothing; the
    rows written are returned.
    """
    # Checked, compared and written: computed once.
    new_runs = cut(new_runs.where(F.col("commit_id").isNotNull()))
    broken = constraint_check(
        new_runs, "execution_id", ("min_approval_count", "min_rejection_count")
    )
    if not broken.isEmpty():
        raise ValueError("the new rows break a table rule; see constraint_check")
    spark = new_runs.sparkSession
    bucket = F.pmod(F.xxhash64("commit_id"), F.lit(buckets)).cast("int")
    touched = [r.b for r in new_runs.select(bucket.alias("b")).distinct().collect()]
    try:
        known = read_stack(spark, path, touched).select("execution_id")
    except AnalysisException:  # the first write
        known = None
    if known is not None:
        new_runs = cut(new_runs.join(known, "execution_id", "left_anti"))
    append_id = uuid.uuid4().hex
    (
        new_runs.withColumns({"bucket": bucket, "append_id": F.lit(append_id)})
        .hint("rebalance", "bucket")
        .write.mode("append")
        .partitionBy("bucket")
        .parquet(path)
    )
    # One file appears at once, so the commits of an append appear together.
    done = new_runs.select("commit_id").distinct().withColumn("append_id", F.lit(append_id))
    done.coalesce(1).write.mode("append").parquet(_manifest(path))
    return new_runs


def keyed_update(runs: DataFrame, updates: DataFrame, key: str = "execution_id") -> DataFrame:
    """Set the columns ``updates`` carries on the rows it names; at most one update per key."""
    changed = [c for c in updates.columns if c != key]
    side = updates.select(
        key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in changed]
    )
    joined = runs.join(side, key, "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in changed
            else F.col(c)
            for c in runs.columns
        ]
    )
