"""Session settings and lineage cuts."""

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SKEW_SETTINGS = {
    # Runtime join choice by measured size, and splitting of skewed join partitions
    # even when the split costs one more shuffle downstream.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sort-free joins where every build partition is measured to be small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    # Keyed state of any number of values a key (votes of a run) lies in this store.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the operators count on."""
    for key, value in _SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return tune(
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cascadia")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        # On one machine a mid-sized broadcast leaves the other side in a single task.
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "1m")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and drop its lineage.

    The folder is the one the cluster names in ``spark.checkpoint.dir``; only a session
    that names none (a test on one machine) gets a temporary one.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="cascadia-")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    A cluster ships it with ``--py-files`` or has it installed; then this path isn't needed.
    """
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder that the driver and all executors can reach.

    It lies under ``spark.checkpoint.dir``; only a local session that names none gets a
    temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="cascadia-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """``df`` written as compressed columns in the shared folder and read again.

    A checkpoint holds whole rows uncompressed; this is for wide rows, of which later steps read
    some columns.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, "kept")
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


#: Characters of a table, written as JSON, up to which it is handed to every task.
SMALL = 4_000_000


def measured(df: DataFrame) -> DataFrame:
    """``df`` stored, and broadcast to what it is joined with if it is measured to be small.

    Adaptive execution measures a side too, but by then it may have shuffled the other one, and by a
    key of few values at that. A table above ``SMALL`` is joined as any other.
    """
    table = kept(df)
    size = table.select(F.sum(F.length(F.to_json(F.struct("*")))).alias("n")).first()["n"]
    return F.broadcast(table) if (size or 0) <= SMALL else table
