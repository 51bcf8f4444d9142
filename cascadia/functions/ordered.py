"""Order-dependent values that survive hot groups.

A window puts a whole group into one task. Where a group has no bound, the caller asks for
slices: the rows are range-partitioned by ``keys + order``, so a
hot group spans many slices, windows run per slice, and per-slice summaries (one row
per group and slice) carry values across slices. Both ways give the same values.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cascadia.session import cut

def _sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    # The slice number depends on sampled range bounds, so it is stored before it is used twice.
    ranged = df.repartitionByRange(*keys, *order)
    return cut(ranged.withColumn("_slice", F.spark_partition_id()))


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    column: str,
    out: str,
    sliced: bool = False,
) -> DataFrame:
    """Add ``out``: the value of ``column`` in the row before, within ``keys`` by ``order``."""
    keys, order = list(keys), list(order)
    if not sliced:
        return df.withColumn(out, F.lag(column).over(Window.partitionBy(*keys).orderBy(*order)))
    rows = _sliced(df, keys, order)
    last = rows.groupBy(*keys, "_slice").agg(
        F.max_by(F.struct(column), F.struct(*order)).getField(column).alias("_last")
    )
    carried = last.withColumn(
        "_carry", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_slice"))
    ).drop("_last")
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    return (
        rows.withColumn("_lag", F.lag(column).over(inside))
        .withColumn("_first", F.row_number().over(inside) == 1)
        .join(carried, [*keys, "_slice"])
        .withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_lag")))
        .drop("_slice", "_lag", "_first", "_carry")
    )


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, str],
    sliced: bool = False,
) -> DataFrame:
    """Add for each ``column: out`` the sum of ``column`` up to and including the row."""
    keys, order = list(keys), list(order)
    upto = (Window.unboundedPreceding, Window.currentRow)
    if sliced:
        return _running_sums_sliced(df, keys, order, sums)
    whole = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*upto)
    return df.withColumns({out: F.sum(c).over(whole) for c, out in sums.items()})


def _running_sums_sliced(df, keys, order, sums):
    upto = (Window.unboundedPreceding, Window.currentRow)
    before = (Window.unboundedPreceding, -1)
    rows = _sliced(df, keys, order)
    totals = rows.groupBy(*keys, "_slice").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    # One row per group and slice: at most as many rows per group as there are slices.
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(*before)
    carried = totals.select(
        *keys,
        "_slice",
        *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_c_{c}") for c in sums],
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(*upto)
    return (
        rows.join(carried, [*keys, "_slice"])
        .withColumns({out: F.col(f"_c_{c}") + F.sum(c).over(inside) for c, out in sums.items()})
        .drop("_slice", *[f"_c_{c}" for c in sums])
    )


def numbered(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Add ``out`` = 1, 2, 3, ... in the global order of ``order``, without one global task."""
    ones = df.withColumn("_one", F.lit(1).cast("bigint"))
    return _running_sums_sliced(ones, [], list(order), {"_one": out}).drop("_one")


def running_steps(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], least: str, step: str, out: str, start: Column
) -> DataFrame:
    """Add ``out``: a running value that each row raises to ``least`` (null: not at all), then by ``step``.

    A row stands for the function m -> max(m, least) + step, and rows one after another for
    m -> max(m + n, c), n being the sum of their steps. Such functions compose, so each range
    slice is summed up as one (n, c), and slices are chained through these alone: no task sees
    more than a slice or one row a slice.
    """
    keys, order = list(keys), list(order)
    upto = (Window.unboundedPreceding, Window.currentRow)
    before = (Window.unboundedPreceding, -1)
    rows = _sliced(df, keys, order)
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(*upto)
    rows = rows.withColumn("_n", F.sum(step).over(inside))
    # What a row's floor amounts to at the start of its slice.
    rows = rows.withColumn("_c", F.max(F.col(least) - (F.col("_n") - F.col(step))).over(inside))
    parts = rows.groupBy(*keys, "_slice").agg(F.sum(step).alias("_all"), F.max("_c").alias("_top"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(*before)
    parts = parts.withColumn("_n0", F.coalesce(F.sum("_all").over(earlier), F.lit(0)))
    carried = parts.select(*keys, "_slice", "_n0", F.max(F.col("_top") - F.col("_n0")).over(earlier).alias("_c0"))
    floor = F.greatest(start, F.col("_c0"), F.col("_c") - F.col("_n0"))
    joined = rows.join(carried, [*keys, "_slice"])
    return joined.withColumn(out, floor + F.col("_n0") + F.col("_n")).drop("_slice", "_n", "_c", "_n0", "_c0")
