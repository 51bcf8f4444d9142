"""Shared folders, stored tables, connected components and small text helpers."""

from __future__ import annotations

import contextlib
import ctypes
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cascadia.session import cut, importable, shared_folder


def stored(df: DataFrame, label: str = "table") -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    Cuts the lineage: a lost executor costs no more than a reread.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Rows of an Arrow batch.
BATCH_ROWS = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def arrow_rows(
    df: DataFrame,
    schema: T.StructType,
    rows: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, list]]],
    flat: Sequence[str] = (),
    store: str | None = None,
) -> DataFrame:
    """``mapInArrow`` over plain columns: ``rows`` turns dicts of lists into dicts of lists.

    Columns named in ``flat`` stay Arrow arrays, which saves their values as Python objects.
    ``store`` names the store that ``rows`` keeps between tasks; a worker drops all others first,
    and what a task has freed goes back to the system when it ends.
    Sets the session's Arrow batches to ``BATCH_ROWS`` rows where they are larger: rows here
    hold whole texts, and a batch exists several times over in the executor and its worker.
    """
    arrow = pa_schema(schema)
    spark = df.sparkSession
    importable(spark)
    if int(spark.conf.get(_BATCH_SETTING)) not in range(1, BATCH_ROWS + 1):
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inputs = (
            {n: c if n in flat else c.to_pylist() for n, c in zip(b.schema.names, b.columns)} for b in batches
        )
        only_store(store)
        try:
            for out in rows(inputs):
                yield pa.RecordBatch.from_arrays(
                    [out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type) for f in arrow],
                    schema=arrow,
                )
        finally:
            release_memory()

    return df.mapInArrow(run, schema)


def pa_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


# What a worker keeps between tasks: one store at a time, as a worker that serves several
# operators would else hold the stores of all.
_STORES: dict[str, Callable[[], None]] = {}


def only_store(name: str | None, clear: Callable[[], None] | None = None) -> None:
    """Empty all stores but ``name``, which ``clear`` empties when another one is in use."""
    for other in [n for n in _STORES if n != name or clear not in (None, _STORES[n])]:
        _STORES.pop(other)()
    if name is not None and clear is not None:
        _STORES[name] = clear


def release_memory() -> None:
    """Give memory back that Arrow and the C library hold for later use."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


#: Bits of a filter that picks rows at a scan: so many for each key, as powers of two within bounds
#: (8 KB and 32 MB).
KEY_BITS, LEAST_BITS, MOST_BITS = 16, 16, 28


def key_filter(keys: DataFrame, key: str) -> np.ndarray:
    """A bitmap of the digests of a binary or text column, sized by their number up to 32 MB.

    It leaves out nearly all rows that a later exact join would, before they are shuffled; a
    full one lets all pass, which costs time but changes nothing.
    """
    size = 1 << min(MOST_BITS, max(LEAST_BITS, (KEY_BITS * keys.count()).bit_length()))
    bit = F.crc32(F.col(key).cast("binary")) % size
    mask = F.expr("shiftleft(1L, cast(bit % 64 AS int))")
    words = (
        keys.select(bit.alias("bit"))
        .select(F.floor(F.col("bit") / 64).alias("word"), mask.alias("mask"))
        .groupBy("word")
        .agg(F.bit_or("mask").alias("mask"))
        .toPandas()
    )
    out = np.zeros(size // 64, dtype=np.int64)
    out[words["word"].to_numpy(dtype=np.int64)] = words["mask"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def in_filter(bits: np.ndarray, keys: Sequence[bytes]) -> np.ndarray:
    """Which keys a filter lets pass."""
    crc = np.fromiter(map(zlib.crc32, keys), dtype=np.uint64, count=len(keys)) % np.uint64(64 * len(bits))
    return (bits[(crc >> np.uint64(6)).astype(np.int64)] >> (crc & np.uint64(63)) & np.uint64(1)).astype(bool)


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node of ``edges``; the component is its least node.

    Alternating star contraction: every node hands its larger neighbours, then its smaller
    ones, to the least neighbour, until all nodes hang on the least node of their component.
    Nodes with many neighbours are aggregated before the shuffle and joined by key, so no
    group is gathered. Null nodes and self-links are ignored.
    """
    lo, hi = F.least(a, b), F.greatest(a, b)
    pairs = cut(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .select(lo.alias("lo"), hi.alias("hi"))
        .where("lo < hi")
        .distinct()
    )
    last = _digest(pairs)
    for _ in range(max_rounds):
        both = pairs.select(F.col("lo").alias("n"), F.col("hi").alias("m")).unionAll(
            pairs.select(F.col("hi").alias("n"), F.col("lo").alias("m"))
        )
        low = both.groupBy("n").agg(F.min("m").alias("low")).select("n", F.least("n", "low").alias("low"))
        large = both.where("m > n").join(low, "n").select(F.col("low").alias("lo"), F.col("m").alias("hi")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("low"))
        small = (
            large.join(least, "hi")
            .select(F.explode(F.array(F.struct(F.col("lo").alias("n"), "low"), F.struct(F.col("hi").alias("n"), "low"))).alias("e"))
            .select(F.col("e.low").alias("lo"), F.col("e.n").alias("hi"))
            .where("lo < hi")
            .distinct()
        )
        pairs = cut(small)
        now = _digest(pairs)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(
        pairs.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )


def _digest(pairs: DataFrame) -> tuple:
    mixed = F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))
    return tuple(pairs.agg(F.count("*"), mixed).first())


def packed(docs: DataFrame, **helpers: Column) -> DataFrame:
    """``docs`` as one column ``row`` beside ``helpers``, whose names so clash with none of it."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in helpers.items()])


def utf8_key(text: Column) -> Column:
    """A key of 128 bits for a whole text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))
