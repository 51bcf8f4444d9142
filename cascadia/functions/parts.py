"""Closed parts of a graph, each solved in one task.

A round over a whole table costs several jobs, however little it moves, and as many rounds follow as
the deepest graph in it asks for. Where columns tell closed parts apart (a graph's id, a commit), a part
of bounded size is handed to a plain function at once. Larger ones are left to rounds.
"""

from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from cascadia.session import importable, measured

#: Rows and list entries of a part up to which one task solves it.
PART = 100_000
_BATCH = 10_000


def split(rows: DataFrame, keys: Sequence[str], odd: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` of other parts than those of ``odd``, and of these, or ``None`` if there are none; keys may be null."""
    odd = measured(odd.select([F.col(k).alias(f"_{k}") for k in keys]).distinct())
    if odd.isEmpty():
        return rows, None
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return rows.join(odd, same, "left_anti"), rows.join(odd, same, "left_semi")


def solved(
    rows: DataFrame, keys: Sequence[str], schema: StructType, solve: Callable[[list[tuple]], Iterable[tuple]]
) -> DataFrame:
    """What ``solve`` makes of the rows of each part, which are of the columns of ``rows``."""
    importable(rows.sparkSession)
    at = [rows.columns.index(k) for k in keys]
    arrow = to_arrow_schema(schema)

    def results(batches: Iterable[pa.RecordBatch]) -> Iterable[tuple]:
        key, part = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                mine = tuple(row[i] for i in at)
                if mine != key:
                    if part:
                        yield from solve(part)
                    key, part = mine, []
                part.append(row)
        if part:
            yield from solve(part)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        def packed(some: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), arrow)], schema=arrow)

        some = []
        for row in results(batches):
            some.append(row)
            if len(some) == _BATCH:
                yield packed(some)
                some = []
        if some:
            yield packed(some)

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def strong_parts(out: Sequence[Iterable[int]]) -> list[int]:
    """The number of the strong component of each node; a component comes after all that it leads to."""
    met, low, part = [0] * len(out), [0] * len(out), [-1] * len(out)
    stack, clock, count = [], 0, 0
    for root in range(len(out)):
        work = [] if met[root] else [(root, iter(out[root]))]
        if work:
            clock += 1
            met[root] = low[root] = clock
            stack.append(root)
        while work:
            node, rest = work[-1]
            for to in rest:
                if not met[to]:
                    clock += 1
                    met[to] = low[to] = clock
                    stack.append(to)
                    work.append((to, iter(out[to])))
                    break
                if part[to] < 0:
                    low[node] = min(low[node], met[to])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[node])
                if low[node] == met[node]:
                    while part[node] < 0:
                        part[stack.pop()] = count
                    count += 1
    return part
