"""Tables that grow round by round and stay where they are.

A fixpoint meets what it knows already in every round. Such a table is dealt out by its key once
and checkpointed as it lies; each round's delta is dealt out the same way and put beside it.
Unions of tables that lie alike are grouped or joined by the key without moving them, so a
round shuffles its delta alone.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascadia.session import cut, kept

_ADAPTIVE = "spark.sql.adaptive.enabled"


def stay(df: DataFrame) -> DataFrame:
    """``df`` checkpointed so that later plans know how it lies.

    An adaptive plan may change its partitions while it runs and so tells nothing about them.
    """
    spark = df.sparkSession
    before = spark.conf.get(_ADAPTIVE)
    spark.conf.set(_ADAPTIVE, "false")
    try:
        return cut(df)
    finally:
        spark.conf.set(_ADAPTIVE, before)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dealt(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` checkpointed, dealt out by ``keys``."""
    return stay(df.repartition(partitions(df), *keys))


def sorted_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` checkpointed, dealt out and sorted by ``keys``: merges with it neither move nor sort it."""
    return stay(df.repartition(partitions(df), *keys).sortWithinPartitions(*keys))


class Grown:
    """A table made of deltas that lie alike; every ``fold`` of them are stored as one, in ``order`` if given."""

    def __init__(self, fold: int = 16, order: Sequence[str] = ()):
        self.fold, self.order = fold, list(order)
        self._folded: list[DataFrame] = []
        self._parts: list[DataFrame] = []

    def add(self, df: DataFrame) -> None:
        self._parts.append(df)
        if len(self._parts) == self.fold:
            # Each row is copied once, not once for every fold after it.
            whole = _union(self._parts)
            self._folded.append(stay(whole.sortWithinPartitions(*self.order) if self.order else whole))
            self._parts = []

    def __bool__(self) -> bool:
        return bool(self._folded or self._parts)

    @property
    def parts(self) -> list[DataFrame]:
        return [*self._folded, *self._parts]

    @property
    def frame(self) -> DataFrame:
        return _union(self.parts)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


#: Copies of an edge list that a frontier meets, so that a node of very many rows is no one task.
SALTS = 16


def salted(edges: DataFrame, keys: Sequence[str], salts: int = SALTS) -> DataFrame:
    """Edges dealt out and sorted by ``keys`` and each salt; one salt is enough where a frontier has a key once."""
    copies = edges.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return sorted_by(copies, [*keys, "_salt"])


def along(frontier: DataFrame, edges: DataFrame, keys: Sequence[str], spread: Column, salts: int = SALTS) -> DataFrame:
    """``frontier`` joined with ``salted`` edges, which don't move; ``spread`` picks a row's salt."""
    rows = frontier.withColumn("_salt", F.pmod(F.hash(spread), F.lit(salts)))
    # Merged, as a frontier may be too large to be hashed: only the frontier is moved and sorted.
    return rows.hint("merge").join(edges, [*keys, "_salt"]).drop("_salt")


def unseen(found: DataFrame, seen: DataFrame | Grown, keys: Sequence[str]) -> DataFrame:
    """Rows of ``found``, each once, that are not in ``seen``, which lies by ``keys``; no key is null.

    Where the parts of ``seen`` are sorted by ``keys``, the new rows alone are sorted; they go past
    each part in one merge.
    """
    rows = found.select(*keys).distinct().repartition(partitions(found), *keys).sortWithinPartitions(*keys)
    for part in seen.parts if isinstance(seen, Grown) else [seen]:
        rows = rows.join(part.select(*keys).hint("merge"), list(keys), "left_anti")
    return rows


def named(df: DataFrame, out: str) -> DataFrame:
    """The distinct rows of ``df``, stored with a number each as ``out``.

    Rounds move and store numbers; names are put back once, at the end.
    """
    return kept(df.distinct().withColumn(out, F.monotonically_increasing_id()))


def reach(
    frontier: DataFrame, edges: DataFrame, key: Sequence[str], node: Sequence[str], max_rounds: int | None = None
) -> list[DataFrame]:
    """What ``edges`` lead to from ``frontier``, one frame a round, the first being ``frontier``.

    ``key`` names the columns of a row, ``node`` those of them that an edge leaves from; edges have
    ``node`` columns and, as ``to_`` columns, where they lead. Rows met before are dropped.
    """
    label = [c for c in key if c not in node]
    salts = SALTS if label else 1
    edges = salted(edges.distinct(), node, salts)
    seen, rounds = Grown(order=key), []
    frontier = sorted_by(frontier.select(*key).distinct(), key)
    while not frontier.isEmpty():
        rounds.append(frontier)
        seen.add(frontier)
        if len(rounds) - 1 == max_rounds:
            raise RuntimeError(f"the closure did not end within {max_rounds} rounds")
        found = along(frontier, edges, node, F.struct(*(label or key)), salts).select(
            *label, *[F.col(f"to_{c}").alias(c) for c in node]
        )
        frontier = stay(unseen(found, seen, key))
    return rounds
