"""Prefix trie of conversations, in balanced parentheses per shard.

Conversations are paths of turns (a turn is the digest of its role and text). Equal paths are
made one, with their number and least conversation, and the paths are sorted into shards.
A shard writes its part of the trie as balanced parentheses, opening where a path leaves the
one before and closing what it left. Minima of the excess over blocks of parentheses, in a
tree, find the close of every node, which delimits its subtree; the rank of adjacent pairs ``()``
counts the leaves there, cumulative arrays over the nodes give members and savings.

Two shards share only nodes on the last path of one and the first of the other, the spines. A shard
hands on its spine nodes with what lies inside it; these rows merge by node. Sums over the spine
trie itself are taken along the paths: a node belongs to the least path through it, so what a path
owns is the end of it, and running sums from the end, added up by node, count each node once.

A path longer than ``PATH_TURNS`` enters its shard with its first turns only and counts as a spine
whole; its further nodes are rows, named by running sums over its turns. So no conversation,
common turn, group of copies or node is one task's list: rows are numbered in range slices, and
the members' ids of a node are strung together in chunks, which pass the digest in one stream.

Defined results: null roles and texts are empty; turns with equal numbers follow each other by
their digest, equal rows stay apart; a null turn comes first; rows without a conversation id belong to
no conversation and are left out; other columns have no part; long texts cost one digest and
one count; no rows give no nodes, not even a root. Nodes are told apart by 128-bit digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cascadia.functions.ordered import running_sums
from cascadia.llm.common import arrow_rows, stored
from cascadia.session import cut

#: Turns of a path that a shard takes in.
PATH_TURNS = 256
#: Turns that are encoded at once.
SHARD_TURNS = 1 << 18
#: Conversations of a group share the first turns of its first one.
GROUP, HEADS = 20, 4
#: Characters of a chunk of member ids.
CHUNK_CHARS = 1 << 14

DIGEST = 16
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# Paths


def _digest(value: Column) -> Column:
    return F.unhex(F.md5(value.cast("binary")))


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, pos, digest, words`` of the rebuilt conversations, and ``conv_id, length`` of all."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        _digest(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        F.lit(1).cast("long").alias("one"),
        # Equal rows are interchangeable; this only spreads them over range slices.
        F.monotonically_increasing_id().alias("tie"),
    )
    # Cut, as the range sampling would read all texts twice.
    own = running_sums(cut(turns), ["conv_id"], ["turn", "digest", "tie"], {"one": "pos"}, sliced=True)
    own = cut(own.select("conv_id", "pos", "digest", "words"))
    first = lambda c: c - c % GROUP
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    counts = own.groupBy("conv_id").agg(F.max("pos").alias("n"))
    bases = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    known = cut(
        counts.withColumns({"heads": heads, "base": first(F.col("conv_id"))})
        .join(bases, "base", "left")
        .select(
            "conv_id",
            "base",
            "heads",
            F.least("heads", F.coalesce("base_n", F.lit(0).cast("long"))).alias("shared"),
            F.greatest(F.col("n") - F.col("heads"), F.lit(0).cast("long")).alias("rest"),
        )
    )
    tails = own.join(known.select("conv_id", "heads", "shared"), "conv_id").where("pos > heads")
    opening = own.where((F.col("pos") < HEADS) & (F.col("conv_id") == first(F.col("conv_id"))))
    opening = opening.withColumnRenamed("conv_id", "base")
    begun = known.where("shared > 0").join(opening, "base").where("pos <= shared")
    columns = ["conv_id", "pos", "digest", "words"]
    moved = tails.withColumn("pos", F.col("pos") - F.col("heads") + F.col("shared"))
    lengths = known.select("conv_id", (F.col("shared") + F.col("rest")).alias("length"))
    return moved.select(columns).unionByName(begun.select(columns)), lengths


def _named(turns: DataFrame, lengths: DataFrame, path_turns: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``conv_id, length, end`` of all; their first turns; the nodes of long paths beyond these.

    ``end`` is the id of a path's last node: the digest of its turns, or, after ``path_turns`` of
    them, of two running sums over hashes of place and turn.
    """
    openings = turns.where(F.col("pos") <= path_turns).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest", "words"))).alias("turns")
    )
    joined = F.expr("aggregate(turns, X'', (acc, t) -> concat(acc, t.digest))")
    openings = lengths.join(openings, "conv_id", "left").select(
        "conv_id",
        "length",
        F.coalesce(joined, F.expr("X''")).alias("path"),
        F.coalesce(F.col("turns.words"), F.array().cast("array<long>")).alias("words"),
    )
    openings = cut(openings.withColumn("end", _digest(F.col("path"))))
    long = F.col("length") > path_turns
    far = turns.join(lengths.where(long), "conv_id")
    place = lambda seed: F.xxhash64(F.lit(seed), "pos", "digest").cast("decimal(38,0)")
    sums = running_sums(far.withColumns({"a": place(1), "b": place(2)}), ["conv_id"], ["pos"], {"a": "sum_a", "b": "sum_b"}, sliced=True)
    name = _digest(F.concat_ws(":", "pos", "sum_a", "sum_b"))
    named = cut(
        sums.where(F.col("pos") > path_turns).select("conv_id", "pos", "words", "length", name.alias("node"))
    )
    ends = named.where("pos = length").select("conv_id", F.col("node").alias("end"))
    plain = openings.where(~long)
    return plain.unionByName(openings.where(long).drop("end").join(ends, "conv_id")), named, openings.where(long)


# A shard's part of the trie

BLOCK = 64


class Parentheses:
    """Balanced parentheses with the minimum excess of every block, in a tree of minima."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.excess = np.cumsum(bits.astype(np.int32) * 2 - 1)
        blocks = -(-len(bits) // BLOCK)
        self.leaves = 1 << max(0, (blocks - 1).bit_length())
        padded = np.full(self.leaves * BLOCK, np.iinfo(np.int32).max, dtype=np.int32)
        padded[: len(bits)] = self.excess
        self.padded = padded
        self.minima = np.empty(2 * self.leaves, dtype=np.int32)
        self.minima[self.leaves :] = padded.reshape(-1, BLOCK).min(axis=1)
        for level in range(self.leaves.bit_length() - 2, -1, -1):
            a, b = 1 << level, 2 << level
            self.minima[a:b] = np.minimum(self.minima[2 * a : 2 * b : 2], self.minima[2 * a + 1 : 2 * b : 2])

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """The matching close of every open: the next place whose excess is one less than there."""
        target = self.excess[opens] - 1
        place = opens + 1
        out = np.full(len(opens), -1, dtype=np.int64)
        todo = np.arange(len(opens))
        # Within the block of the open.
        while len(todo):
            at = place[todo]
            todo, at = todo[at % BLOCK != 0], at[at % BLOCK != 0]
            hit = self.padded[at] == target[todo]
            out[todo[hit]] = at[hit]
            todo = todo[~hit]
            place[todo] += 1
        todo = np.flatnonzero(out < 0)
        if not len(todo):
            return out
        # Up to the first subtree of blocks on the right that falls as low, then down to its block.
        node = self.leaves + (place[todo] - 1) // BLOCK
        wanted = target[todo]
        climbing = np.ones(len(todo), dtype=bool)
        while climbing.any():
            right = np.where(climbing & (node % 2 == 0), node + 1, node)
            low = climbing & (right != node) & (self.minima[right] <= wanted)
            node = np.where(low, right, np.where(climbing, node >> 1, node))
            climbing &= ~low
        while (down := node < self.leaves).any():
            left = 2 * node
            low = self.minima[np.where(down, left, node)] <= wanted
            node = np.where(down, np.where(low, left, left + 1), node)
        at = (node - self.leaves) * BLOCK
        left = np.arange(len(todo))
        while len(left):
            hit = self.padded[at[left]] == wanted[left]
            out[todo[left[hit]]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
        return out


def _common(a: bytes, b: bytes) -> int:
    """Number of leading digests that two paths share."""
    n = min(len(a), len(b)) // DIGEST
    if a[: n * DIGEST] == b[: n * DIGEST]:
        return n
    lo, hi = 0, n - 1
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[: mid * DIGEST] == b[: mid * DIGEST]:
            lo = mid
        else:
            hi = mid - 1
    return lo


INNER, SPINE, PLACE = 0, 1, 2
_NODES = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),
        T.StructField("shard", T.LongType()),
        T.StructField("path", T.BinaryType()),
        T.StructField("node", T.BinaryType()),
        T.StructField("parent", T.BinaryType()),
        *(
            T.StructField(n, T.LongType())
            for n in ("depth", "conv_id", "parent_conv_id", "words", "n_convs", "n_children", "n_leaves", "saved_tokens")
        ),
    ]
)


def encode(rows: list[tuple[bytes, list[int], int, int, bool, bytes]], shard: int) -> Iterator[dict[str, list]]:
    """Nodes of sorted rows ``(path, words, n, conv, is_long, end)``: inner ones, spines, their paths."""
    ids, depth, parent, words, bits = [hashlib.md5().digest()], [0], [-1], [0], [1]
    weight, least = [0], [np.iinfo(np.int64).max]
    # The path from the root to the row at hand, and the running digests along it.
    stack, states, before = [0], [hashlib.md5()], b""
    spine, places = set(), []
    for r, (path, counts, n, conv, is_long, end) in enumerate(rows):
        shared = _common(before, path)
        bits += [0] * (len(stack) - 1 - shared)
        del stack[shared + 1 :], states[shared + 1 :]
        for d in range(shared, len(path) // DIGEST):
            state = states[-1].copy()
            state.update(path[d * DIGEST : (d + 1) * DIGEST])
            states.append(state)
            parent.append(stack[-1])
            stack.append(len(ids))
            ids.append(state.digest())
            depth.append(d + 1)
            words.append(counts[d])
            weight.append(0)
            least.append(np.iinfo(np.int64).max)
            bits.append(1)
        weight[stack[-1]] += n
        least[stack[-1]] = min(least[stack[-1]], conv)
        if is_long or r in (0, len(rows) - 1):
            spine.update(stack)
            places += [(end, ids[v], depth[v]) for v in stack]
        before = path
    bits += [0] * len(stack)

    bits, total = np.array(bits, dtype=np.int8), len(ids)
    opens = np.flatnonzero(bits)
    closes = Parentheses(bits).findclose(opens)
    after = np.arange(total) + (closes - opens + 1) // 2
    upto = lambda x: np.concatenate([[0], np.cumsum(x)])
    own = np.array(weight, dtype=np.int64)
    n_convs = (c := upto(own))[after] - c[:-1]
    low = np.append(np.array(least, dtype=np.int64), np.iinfo(np.int64).max)
    conv = np.minimum.reduceat(low, np.column_stack([np.arange(total), after]).ravel())[::2]
    is_spine = np.zeros(total, dtype=bool)
    is_spine[list(spine)] = True
    above = np.array(parent)
    children = np.bincount(above[1:][~is_spine[1:]], minlength=total)
    # Adjacent pairs are leaves; those of spine nodes may have children elsewhere and count later.
    pairs = np.zeros(len(bits), dtype=np.int64)
    pairs[:-1] = (bits[:-1] == 1) & (bits[1:] == 0)
    pairs[opens[is_spine]] = 0
    leaves = (rank := upto(pairs))[closes] - rank[opens]
    tokens = np.array(words, dtype=np.int64)
    value = np.where(is_spine, 0, (n_convs - 1) * tokens)
    saved = (c := upto(value))[after] - c[:-1]

    held = np.append(conv, 0)
    for kind, chosen in ((INNER, np.flatnonzero(~is_spine)), (SPINE, np.flatnonzero(is_spine))):
        size = len(chosen)
        up = above[chosen]
        own_parent = (kind == INNER) & ~is_spine[up]
        yield {
            "kind": [kind] * size,
            "shard": [shard] * size,
            "path": [None] * size,
            "node": [ids[v] for v in chosen],
            "parent": [ids[v] if v >= 0 else None for v in up],
            "depth": [depth[v] for v in chosen],
            "conv_id": conv[chosen].tolist(),
            "parent_conv_id": [int(c) if o else None for c, o in zip(held[up], own_parent)],
            "words": tokens[chosen].tolist(),
            "n_convs": n_convs[chosen].tolist(),
            "n_children": children[chosen].tolist(),
            "n_leaves": leaves[chosen].tolist(),
            "saved_tokens": saved[chosen].tolist(),
        }
    blank = [None] * len(places)
    yield {f.name: blank for f in _NODES} | {
        "kind": [PLACE] * len(places),
        "path": [p for p, _, _ in places],
        "node": [n for _, n, _ in places],
        "depth": [d for _, _, d in places],
    }


def _shards(shard_turns: int):
    def rows(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        held, turns, number = [], 0, TaskContext.get().partitionId() << 32
        for b in batches:
            for row in zip(b["path"], b["words"], b["n_convs"], b["conv_id"], b["is_long"], b["end"]):
                held.append(row)
                turns += 1 + len(row[1])
                if turns >= shard_turns:
                    yield from encode(held, number)
                    held, turns, number = [], 0, number + 1
        if held:
            yield from encode(held, number)

    return rows


# The digest of the conversations that end in a node


def _chunks(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
    end, first, ids, size = None, None, [], 0
    for b in batches:
        out: dict[str, list] = {"end": [], "first": [], "chunk": []}
        for this, conv in zip(b["end"], b["conv_id"]):
            if ids and (this != end or size > CHUNK_CHARS):
                for column, value in zip(out.values(), (end, first, ",".join(ids))):
                    column.append(value)
                ids, size = [], 0
            if not ids:
                end, first = this, conv
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        yield out
    if ids:
        yield {"end": [end], "first": [first], "chunk": [",".join(ids)]}


def _hashed(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
    end, state = None, None
    for b in batches:
        out: dict[str, list] = {"end": [], "ends_sha256": []}
        for this, chunk in zip(b["end"], b["chunk"]):
            if this != end:
                if state:
                    out["end"].append(end)
                    out["ends_sha256"].append(state.hexdigest())
                end, state = this, hashlib.sha256(chunk.encode())
            else:
                state.update(b"," + chunk.encode())
        yield out
    if state:
        yield {"end": [end], "ends_sha256": [state.hexdigest()]}


def ends_digest(ends: DataFrame) -> DataFrame:
    """``end, ends_sha256``: SHA-256 of the ascending, comma-joined conversations of each end."""
    chunk = T._parse_datatype_string("end binary, first long, chunk string")
    digest = T._parse_datatype_string("end binary, ends_sha256 string")
    ranged = ends.select("end", "conv_id").repartitionByRange("end", "conv_id").sortWithinPartitions("end", "conv_id")
    chunks = arrow_rows(ranged, chunk, _chunks)
    return arrow_rows(chunks.repartition("end").sortWithinPartitions("end", "first"), digest, _hashed)


# The whole trie


def conversation_trie(
    conversations: DataFrame, path_turns: int = PATH_TURNS, shard_turns: int = SHARD_TURNS
) -> DataFrame:
    """One row a node of the trie of rebuilt conversations; see the module for its columns."""
    turns, lengths = rebuilt_turns(conversations)
    ends, tail_turns, long = _named(cut(turns), lengths, path_turns)
    ends = cut(ends)
    paths = ends.groupBy("end").agg(
        F.first("path").alias("path"),
        F.first("words").alias("words"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        (F.first("length") > path_turns).alias("is_long"),
    )
    ranged = paths.repartitionByRange("path", "end").sortWithinPartitions("path", "end")
    found = stored(arrow_rows(ranged, _NODES, _shards(shard_turns)), "trie")

    # Long paths beyond what shards take in: the turns of their least conversation.
    kept = cut(paths.where("is_long").select("end", "n_convs", "conv_id"))
    last = long.select("conv_id", F.lit(path_turns).cast("long").alias("pos"), F.col("end").alias("node"))
    far = kept.join(tail_turns, "conv_id")
    above = tail_turns.select("conv_id", "pos", "node").unionByName(last)
    above = above.select("conv_id", (F.col("pos") + 1).alias("pos"), F.col("node").alias("parent"))
    far = far.join(above, ["conv_id", "pos"])
    zero = F.lit(0).cast("long")
    tails = far.select(
        F.lit(None).cast("long").alias("shard"), "node", "parent", F.col("pos").alias("depth"), "conv_id", "words",
        "n_convs", zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens"),
    )
    places = found.where(f"kind = {PLACE}").select("path", "node", "depth").distinct()
    places = places.unionByName(far.select(F.col("end").alias("path"), "node", F.col("pos").alias("depth")))
    parts = found.where(f"kind = {SPINE}").select(tails.columns)
    spines = _merged_spines(parts.drop("shard").unionByName(tails.drop("shard")), places)

    # Inner nodes under a spine node take its conversation, shard by shard.
    heads = parts.select("shard", "node").join(spines.select("node", "conv_id"), "node").select(
        "shard", F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")
    )
    inner = found.where(f"kind = {INNER}")
    under = inner.where("parent_conv_id IS NULL").drop("parent_conv_id").join(heads, ["shard", "parent"])
    up = spines.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    nodes = (
        inner.where("parent_conv_id IS NOT NULL").select(columns)
        .unionByName(under.select(columns))
        .unionByName(spines.join(up, "parent", "left").select(columns))
    )
    digests = ends_digest(ends).withColumnRenamed("end", "node")
    return nodes.join(digests, "node", "left").select(
        *columns[1:], F.coalesce("ends_sha256", F.lit(_EMPTY_SHA)).alias("ends_sha256")
    )


def _merged_spines(parts: DataFrame, places: DataFrame) -> DataFrame:
    """Spine nodes whole: parts of all shards added, sums over the spine trie by running sums."""
    merged = parts.groupBy("node").agg(
        *[F.first(c).alias(c) for c in ("parent", "depth", "words")],
        F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    merged = cut(merged)
    more = merged.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("more"))
    merged = cut(
        merged.join(more, "node", "left")
        .withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
        .drop("more")
    )
    places = cut(places)
    owners = places.groupBy("node").agg(F.min("path").alias("owner"))
    worth = merged.join(owners, "node").select(
        "node",
        "owner",
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    mine = F.col("owner") == F.col("path")
    along = places.join(worth, "node").select(
        "path", "node", (-F.col("depth")).alias("up"), *[F.when(mine, F.col(c)).otherwise(0).alias(c) for c in ("leaf", "saved")]
    )
    along = running_sums(along, ["path"], ["up"], {"leaf": "leaves", "saved": "tokens"}, sliced=True)
    sums = along.groupBy("node").agg(F.sum("leaves").alias("leaves"), F.sum("tokens").alias("tokens"))
    whole = merged.join(sums, "node")
    return cut(
        whole.withColumns(
            {"n_leaves": F.col("n_leaves") + F.col("leaves"), "saved_tokens": F.col("saved_tokens") + F.col("tokens")}
        ).drop("leaves", "tokens")
    )
