"""Language-model scores by context-tree weighting over bytes.

A text counts as its words (bytes but white space, A-Z lower-cased), a space between two words
and an end byte after the last: a text without words is the end byte alone. Every byte is eight
binary decisions, each made in the node of its partial byte; every such node has a context tree
over the bytes before it, nearest first, ``depth`` deep. The bytes before a text's first are end
bytes, so texts don't depend on each other.

Training gives each tree node the zeros and ones seen there. Its block probability is the
Krichevsky-Trofimov estimate, log Pe = lgamma(a + 1/2) + lgamma(b + 1/2) - lgamma(a + b + 1) -
log pi; weighted with its children, Pw = Pe / 2 + (product of the children's Pw) / 2, and Pw = Pe at
full depth. After training, Pe / (2 Pw) is the share of the weight that stops in a node, and
the probability of a bit mixes (ones + 1/2) / (all + 1) of the nodes on its path by these shares.
Where the path leaves what training has seen, the weight stops at its last node seen.
A score is the sum of log10 over all bits; ``-score / log10(2) / bytes`` is the code length.

How it runs. A byte's probability depends on its gram alone, the byte and the ``depth`` before it.

1. Documents are dealt to blocks of about ``BLOCK_BYTES`` by a hash of their row. A block hands on
   its distinct grams and word hashes, once each, with their counts in training texts, cut by
   hash into rows for buckets, whose number grows with the input.
2. A bucket adds the counts of its words and answers every block; it adds those of its grams.
3. Grams meet again by the two bytes before them, where whole subtrees from depth 2 on stand
   together. First these give their share in the two levels on top, which have at most 256 * 255
   and 255 nodes whatever the corpus: those are weighted on the driver and sent to all. Then they
   give each gram its probability, which goes back by bucket to the blocks that asked.
4. A block's answers come before its documents, in one sorted stream, and each document is a
   sum over look-ups.

A common word, gram or text costs each block one entry, so nothing is gathered by key; the
grams of one pair of bytes are at most 256**(depth - 1). Words are told apart by 64-bit hashes:
among 10**8 distinct words, two share one with a probability of about 3e-4.

Defined results: a null text counts as empty and has one token, the end; a null key is not held out, as
its remainder is null; rows with equal keys are scored each; other columns have no part; a long
text is worked off whole, in slices; without training texts every bit has probability 1/2, all counts,
N and V are 0 and the base score is 0 (log10 of 1 / 1).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cascadia.llm import flat
from cascadia.llm.common import arrow_rows, stored

DEPTH = 5
#: Bytes of a block, and what a small table is still cut into to work in parallel.
BLOCK_BYTES, LEAST_BYTES = 48 << 20, 4 << 20
#: Entries that a bucket holds on average, and grams of a group of subtrees.
BUCKET_ENTRIES = 2_000_000
#: Bytes that a task works off at once.
SLICE_BYTES = 1 << 19

SPACE, END = flat.SPACE, 0x0A
#: A-Z to lower case, white space to one kind.
_FOLD = flat.FOLD.tobytes()
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOG2 = float(np.log(2.0))


# Bytes to grams and words


def byte_sequence(texts: list[bytes | None], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, ``depth`` end bytes before each, and each text's number of bytes."""
    parts, sizes, pad = [], np.empty(len(texts), dtype=np.int64), bytes([END]) * depth
    for i, text in enumerate(texts):
        words = b" ".join((text or b"").translate(_FOLD).split())
        parts += [pad, words, b"\n"]
        sizes[i] = len(words) + 1
    return np.frombuffer(b"".join(parts), dtype=np.uint8), sizes


def grams_of(data: np.ndarray, sizes: np.ndarray, depth: int) -> np.ndarray:
    """For each byte but the padding, it and the ``depth`` bytes before it as one number."""
    n = len(data) - depth
    grams = np.zeros(max(n, 0), dtype=np.uint64)
    for i in range(depth + 1):
        grams = (grams << np.uint64(8)) | data[i : n + i]
    # The position of byte k of the data is k - depth; padding begins where a text ends.
    real = np.ones(len(grams), dtype=bool)
    starts = np.cumsum(sizes + depth)[:-1] - depth
    for k in range(depth):
        real[starts + k] = False
    return grams[real]


def words_of(data: np.ndarray, sizes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, and each text's number of words."""
    letter = (data != SPACE) & (data != END)
    # Words may hold no white space, so an end byte is always one of ours.
    edge = np.diff(letter.astype(np.int8), prepend=0, append=0)
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    counts = np.diff(np.searchsorted(start, np.cumsum(sizes + depth)), prepend=0)
    return flat.span_hashes(np.append(data, np.zeros(flat.SPARE, dtype=np.uint8)), start, stop - start), counts


def in_order(keys: np.ndarray, used: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and keys in ascending order, a run of places at a time; keys use their low ``used`` bits.

    Where a key leaves room for its place, one sort of both together is several times faster.
    """
    free = min(64 - used, 20)
    if free < 16:
        order = np.argsort(keys, kind="stable")
        yield order, keys[order]
        return
    for a in range(0, len(keys), 1 << free):
        part = keys[a : a + (1 << free)]
        both = np.sort(part << np.uint64(free) | np.arange(len(part), dtype=np.uint64))
        yield a + (both & np.uint64((1 << free) - 1)).astype(np.int64), both >> np.uint64(free)


def counted_once(keys: np.ndarray, training: np.ndarray, used: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and how many of each are training's."""
    if used > 63:
        found, place = np.unique(keys, return_inverse=True)
        return found, np.bincount(place, training, len(found)).astype(np.int64)
    pairs, counts = np.unique(keys << np.uint64(1) | training.astype(np.uint64), return_counts=True)
    both = pairs >> np.uint64(1)
    first = np.flatnonzero(np.diff(both, prepend=~both[:1])) if len(both) else np.empty(0, np.int64)
    return both[first], np.add.reduceat(counts * (pairs & np.uint64(1)).astype(np.int64), first) if len(first) else np.empty(0, np.int64)


# The weighted trees


def _lgamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x >= 1/2: Stirling's series after a shift by 8."""
    shift = np.ones_like(x)
    for k in range(8):
        shift = shift * (x + k)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


def block_log(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    a, b = zeros.astype(np.float64), ones.astype(np.float64)
    return _lgamma(a + 0.5) + _lgamma(b + 0.5) - _lgamma(a + b + 1) - np.log(np.pi)


class Level:
    """The nodes of one depth: keys (context << 8 | partial byte), counts, share that stops."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray | None):
        self.keys, self.zeros, self.ones = keys, zeros, ones
        own = block_log(zeros, ones)
        if children is None:
            self.weighted, self.stop = own, np.ones(len(keys))
        else:
            self.weighted = np.logaddexp(own, children) - _LOG2
            self.stop = np.exp(own - _LOG2 - self.weighted)
        self.one = (ones + 0.5) / (zeros + ones + 1)

    def parents(self, depth: int) -> np.ndarray:
        """Keys of the nodes above, ``depth`` being that of this level."""
        context = (self.keys >> np.uint64(8)) & np.uint64((1 << 8 * (depth - 1)) - 1)
        return context << np.uint64(8) | self.keys & np.uint64(255)


def _decisions(grams: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The eight decisions of each gram's byte: the partial byte before, and the bit."""
    byte = (grams & np.uint64(255)) | np.uint64(256)
    for k in range(8, 0, -1):
        yield byte >> np.uint64(k), (byte >> np.uint64(k - 1)) & np.uint64(1)


def _context(grams: np.ndarray, depth: int) -> np.ndarray:
    return (grams >> np.uint64(8)) & np.uint64((1 << 8 * depth) - 1)


def _counted(keys: np.ndarray, ones: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found, place = np.unique(keys, return_inverse=True)
    all_, one = np.bincount(place, counts, len(found)), np.bincount(place, counts * ones, len(found))
    return found, all_ - one, one


def grow(grams: np.ndarray, counts: np.ndarray, depth: int, top: int) -> dict[int, Level]:
    """The levels from ``depth`` up to ``top`` over counted grams."""
    seen = counts > 0
    grams, counts = grams[seen], counts[seen].astype(np.float64)
    levels: dict[int, Level] = {}
    for k in range(depth, top - 1, -1):
        context = _context(grams, k) << np.uint64(8)
        steps = list(_decisions(grams))
        keys = np.concatenate([context | node for node, _ in steps]) if len(grams) else np.empty(0, np.uint64)
        bits = np.concatenate([bit for _, bit in steps]) if len(grams) else np.empty(0, np.uint64)
        found, zeros, ones = _counted(keys, bits.astype(np.float64), np.tile(counts, 8))
        below = None
        if k < depth:
            under = levels[k + 1]
            below = np.bincount(np.searchsorted(found, under.parents(k + 1)), under.weighted, len(found))
        levels[k] = Level(found, zeros, ones, below)
    return levels


def summed(level: Level, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per node above ``level``: key, zeros, ones and the sum of its children's weighted logs."""
    keys, place = np.unique(level.parents(depth), return_inverse=True)
    sums = (np.bincount(place, x, len(keys)) for x in (level.zeros, level.ones, level.weighted))
    return (keys, *(x.astype(np.float64) for x in sums))


def log10_bytes(grams: np.ndarray, levels: dict[int, Level]) -> np.ndarray:
    """log10 of the probability of each gram's byte after its context."""
    out = np.zeros(len(grams))
    for node, bit in _decisions(grams):
        chance, deeper = np.full(len(grams), 0.5), np.zeros(len(grams), dtype=bool)
        for k in sorted(levels, reverse=True):
            level = levels[k]
            if not len(level.keys):
                continue
            keys = _context(grams, k) << np.uint64(8) | node
            place = np.minimum(np.searchsorted(level.keys, keys), len(level.keys) - 1)
            found = level.keys[place] == keys
            one = level.one[place]
            here = np.where(bit == 1, one, 1 - one)
            stop = np.where(deeper, level.stop[place], 1.0)
            chance = np.where(found, stop * here + (1 - stop) * chance, chance)
            deeper = found
        out += np.log10(chance)
    return out


# Entries of a block, and their way to the buckets and back

GRAM, WORD = 0, 1
_ENTRIES = "block long, kind int, keys binary, counts binary"


class _Counts:
    """Distinct keys of one block with their counts in training texts; merged as they grow."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size, self.limit = 0, 1 << 20

    def add(self, keys: np.ndarray, training: np.ndarray, used: int) -> None:
        self.parts.append(counted_once(keys, training, used))
        self.size += len(self.parts[-1][0])
        if self.size > self.limit:
            self.merge()
            self.limit = self.size + (1 << 19)

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.parts) != 1:
            self.parts = [_added(self.parts)]
        self.size = len(self.parts[0][0])
        return self.parts[0]


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    keys = np.concatenate([k for k, _ in parts])
    order = np.argsort(keys)
    keys, counts = keys[order], np.concatenate([c for _, c in parts])[order]
    del order
    first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _slices(batch: dict[str, list]) -> Iterator[slice]:
    """Rows of a batch, about ``SLICE_BYTES`` of text at a time."""
    first = size = 0
    for i, text in enumerate(batch["text"]):
        size += len(text or b"")
        if size >= SLICE_BYTES:
            yield slice(first, i + 1)
            first, size = i + 1, 0
    if first < len(batch["text"]):
        yield slice(first, len(batch["text"]))


def _block_entries(depth: int):
    def rows(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        block, tables = None, {}

        def entries():
            for kind, table in tables.items():
                keys, counts = table.merge()
                for at in range(0, len(keys), BUCKET_ENTRIES):
                    part = slice(at, at + BUCKET_ENTRIES)
                    yield {"block": [block], "kind": [kind], "keys": [keys[part].tobytes()], "counts": [counts[part].tobytes()]}

        for batch in batches:
            for part in _slices(batch):
                blocks = np.array(batch["block"][part])
                cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1), len(blocks)]
                for a, b in zip(cuts, cuts[1:]):
                    if blocks[a] != block:
                        yield from entries()
                        block, tables = int(blocks[a]), {GRAM: _Counts(), WORD: _Counts()}
                    data, sizes = byte_sequence(batch["text"][part][a:b], depth)
                    training = ~np.array(batch["held_out"][part][a:b], dtype=bool)
                    tables[GRAM].add(grams_of(data, sizes, depth), np.repeat(training, sizes), 8 * depth + 8)
                    words, counts = words_of(data, sizes, depth)
                    tables[WORD].add(words, np.repeat(training, counts), 64)
        yield from entries()

    return rows


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (flat.mixed(keys + _STEP) % np.uint64(buckets)).astype(np.int64)


def _dealt(buckets: int, *columns: str):
    """Cut rows of keys and values by bucket."""

    def rows(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            for i, data in enumerate(batch["keys"]):
                keys, values = np.frombuffer(data, np.uint64), np.frombuffer(batch["counts"][i], np.int64)
                bucket = _bucket_of(keys, buckets)
                order = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                parts = np.split(order, cuts[1:]) if len(cuts) else []
                yield {
                    "bucket": [int(bucket[p[0]]) for p in parts],
                    **{c: [batch[c][i]] * len(parts) for c in columns},
                    "keys": [keys[p].tobytes() for p in parts],
                    "counts": [values[p].tobytes() for p in parts],
                }

    return rows


def _table(rows: pa.Table, values: str, dtype: type) -> tuple[list[np.ndarray], list[np.ndarray]]:
    keys = [np.frombuffer(k, np.uint64) for k in rows["keys"].to_pylist()]
    return keys, [np.frombuffer(v, dtype) for v in rows[values].to_pylist()]


_ANSWERS = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("keys", T.BinaryType()),
        T.StructField("answers", T.BinaryType()),
        T.StructField("total", T.LongType()),
        T.StructField("distinct", T.LongType()),
    ]
)


def _answer_words(rows: pa.Table) -> pa.Table:
    """The corpus counts of a bucket's words to each block, and the bucket's own figures."""
    keys, counts = _table(rows, "counts", np.int64)
    found, total = _added(list(zip(keys, counts)))
    blocks = rows["block"].to_pylist()
    return pa.table(
        {
            "block": pa.array([*blocks, None], pa.int64()),
            "keys": pa.array([*(k.tobytes() for k in keys), None], pa.binary()),
            "answers": pa.array([*(total[np.searchsorted(found, k)].tobytes() for k in keys), None], pa.binary()),
            "total": pa.array([*([None] * len(keys)), int(total.sum())], pa.int64()),
            "distinct": pa.array([*([None] * len(keys)), int((total > 0).sum())], pa.int64()),
        }
    )


def _add_grams(groups: int):
    """The counts of a bucket's grams, cut by the two bytes before the byte."""

    def run(rows: pa.Table) -> pa.Table:
        bucket = rows["bucket"][0].as_py()
        found, total = _added(list(zip(*_table(rows, "counts", np.int64))))
        group = _bucket_of(_context(found, 2), groups)
        parts = [np.flatnonzero(group == g) for g in np.unique(group)]
        return pa.table(
            {
                "bucket": pa.array([bucket] * len(parts), pa.int64()),
                "group": pa.array([int(group[p[0]]) for p in parts], pa.int64()),
                "keys": pa.array([found[p].tobytes() for p in parts], pa.binary()),
                "counts": pa.array([total[p].tobytes() for p in parts], pa.binary()),
            }
        )

    return run


def _share_above(depth: int):
    """What a group of subtrees gives to the level above them."""

    def run(rows: pa.Table) -> pa.Table:
        keys, counts = _table(rows, "counts", np.int64)
        parts = summed(grow(np.concatenate(keys), np.concatenate(counts), depth, 2)[2], 2)
        names = ("node", "zeros", "ones", "weighted")
        return pa.table({n: pa.array(p.astype(np.int64) if n == "node" else p) for n, p in zip(names, parts)})

    return run


def _chances(depth: int, top):
    """log10 probabilities of a group's grams, cut by bucket."""

    def run(rows: pa.Table) -> pa.Table:
        levels = {k: Level(*x) for k, x in top.value.items()}
        keys, counts = _table(rows, "counts", np.int64)
        levels |= grow(np.concatenate(keys), np.concatenate(counts), depth, 2)
        return pa.table(
            {
                "bucket": rows["bucket"],
                "keys": rows["keys"],
                "values": pa.array([log10_bytes(k, levels).tobytes() for k in keys], pa.binary()),
            }
        )

    return run


def _answer_grams(asked: pa.Table, given: pa.Table) -> pa.Table:
    """The probabilities of a bucket's grams to each block."""
    keys, values = _table(given, "values", np.float64)
    found, value = np.concatenate([np.empty(0, np.uint64), *keys]), np.concatenate([np.empty(0), *values])
    order = np.argsort(found)
    found, value = found[order], value[order]
    wanted = [np.frombuffer(k, np.uint64) for k in asked["keys"].to_pylist()]
    return pa.table(
        {
            "block": asked["block"],
            "keys": asked["keys"],
            "answers": pa.array([value[np.searchsorted(found, k)].tobytes() for k in wanted], pa.binary()),
        }
    )


def _top_levels(shares: DataFrame) -> dict[int, tuple]:
    """Depths 1 and 0 from the sums over all groups: at most 256 * 255 rows."""
    sums = shares.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "weighted")])
    found = sums.orderBy("node").toPandas()
    one = [found[c].to_numpy(dtype=np.float64) for c in ("zeros", "ones", "weighted")]
    first = (found["node"].to_numpy(dtype=np.int64).astype(np.uint64), *one)
    return {1: first, 0: summed(Level(*first), 1)}


# Scores


def _scores(depth: int):
    def rows(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        block, answers, tables = None, {}, {}
        for batch in batches:
            docs: list[int] = []
            out = []

            def score(docs: list[int]) -> Iterator[dict[str, list]]:
                part = {c: [batch[c][i] for i in docs] for c in ("text", "key", "held_out")}
                for s in _slices(part):
                    yield _scored(part["text"][s], tables, depth) | {c: part[c][s] for c in ("key", "held_out")}

            for i, kind in enumerate(batch["kind"]):
                if batch["block"][i] != block:
                    out += score(docs) if docs else []
                    block, answers, tables, docs = batch["block"][i], {GRAM: [], WORD: []}, {}, []
                if kind is None:
                    if not tables:
                        tables = {k: _sorted(parts) for k, parts in answers.items()}
                        answers = {}
                    docs.append(i)
                else:
                    dtype = np.float64 if kind == GRAM else np.int64
                    answers[kind].append(
                        (np.frombuffer(batch["keys"][i], np.uint64), np.frombuffer(batch["answers"][i], dtype))
                    )
            yield from out
            if docs:
                yield from score(docs)

    return rows


def _sorted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.empty(0, np.uint64), np.empty(0)
    keys, values = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys)
    return keys[order], values[order]


def _scored(texts: list[bytes | None], tables: dict, depth: int) -> dict[str, list]:
    data, sizes = byte_sequence(texts, depth)
    keys, values = tables[GRAM]
    grams = grams_of(data, sizes, depth)
    chances = np.empty(len(grams))
    for place, key in in_order(grams, 8 * depth + 8):
        chances[place] = values[np.searchsorted(keys, key)]
    words, n_words = words_of(data, sizes, depth)
    keys, values = tables[WORD]
    counts = values[np.searchsorted(keys, words)] if len(words) else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(texts)), n_words)
    return {
        "n_words": n_words.tolist(),
        "n_known": np.bincount(owner, counts > 0, len(texts)).astype(np.int64).tolist(),
        "log_counts": np.bincount(owner, np.log10(counts + 1.0), len(texts)).tolist(),
        "n_bytes": sizes.tolist(),
        "score": np.add.reduceat(chances, np.cumsum(sizes) - sizes).tolist(),
    }


_SCORED = T.StructType(
    [
        T.StructField("key", T.LongType()),
        T.StructField("held_out", T.BooleanType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_known", T.LongType()),
        T.StructField("log_counts", T.DoubleType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def score_documents(
    docs: DataFrame,
    held_out: Column,
    key: str = "doc_id",
    text: str = "text",
    depth: int = DEPTH,
    block_bytes: int = BLOCK_BYTES,
    bucket_entries: int = BUCKET_ENTRIES,
) -> DataFrame:
    """Per row of ``docs`` its key, ``held_out``, token counts, unigram score and model score.

    Rows where ``held_out`` isn't true train the model. Tokens are words and the end of the text;
    ``n_known`` of them were seen in training, ``train_tokens`` is their number there,
    ``base_score`` the add-one unigram log10 probability, ``score`` that of the context trees,
    ``bits_per_byte`` its code length.
    """
    if not 2 <= depth <= 7:
        raise ValueError("depth must lie between 2 and 7: a gram is one 64-bit number")
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).cast("long").alias("key"),
        F.col(text).cast("binary").alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    figures = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size"),
        F.count_if(~F.col("held_out")).alias("training"),
    ).first()
    size = figures["size"] + 64 * figures["n"]
    blocks = max(1, -(-size // block_bytes), min(spark.sparkContext.defaultParallelism, -(-size // LEAST_BYTES)))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("key", "text"), F.lit(blocks)))

    by_block = dealt.repartitionById(int(blocks), F.col("block").cast("int")).sortWithinPartitions("block")
    entries = stored(arrow_rows(by_block, T._parse_datatype_string(_ENTRIES), _block_entries(depth)), "entries")
    n_entries = entries.agg(F.coalesce(F.sum(F.length("keys")), F.lit(0)).alias("n")).first()["n"] // 8
    buckets = max(1, -(-n_entries // bucket_entries))

    asked = T._parse_datatype_string("bucket long, block long, keys binary, counts binary")
    words = arrow_rows(entries.where(f"kind = {WORD}"), asked, _dealt(buckets, "block"))
    words = stored(words.groupBy("bucket").applyInArrow(_answer_words, _ANSWERS), "word-counts")
    corpus = words.where("block IS NULL").agg(
        F.coalesce(F.sum("total"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("distinct"), F.lit(0)).alias("types")
    ).first()

    grams = arrow_rows(entries.where(f"kind = {GRAM}"), asked, _dealt(buckets, "block"))
    added = T._parse_datatype_string("bucket long, group long, keys binary, counts binary")
    model = stored(grams.groupBy("bucket").applyInArrow(_add_grams(buckets), added), "grams")
    shares = T._parse_datatype_string("node long, zeros double, ones double, weighted double")
    top = spark.sparkContext.broadcast(_top_levels(model.groupBy("group").applyInArrow(_share_above(depth), shares)))
    valued = T._parse_datatype_string("bucket long, keys binary, values binary")
    chances = model.groupBy("group").applyInArrow(_chances(depth, top), valued)
    answered = T._parse_datatype_string("block long, keys binary, answers binary")
    gram_answers = grams.groupBy("bucket").cogroup(chances.groupBy("bucket")).applyInArrow(_answer_grams, answered)

    none = lambda kind: F.lit(None).cast(kind)
    stream = (
        gram_answers.select("block", F.lit(GRAM).alias("kind"), "keys", "answers")
        .unionByName(words.where("block IS NOT NULL").select("block", F.lit(WORD).alias("kind"), "keys", "answers"))
        .select("*", none("long").alias("key"), none("binary").alias("text"), none("boolean").alias("held_out"))
        .unionByName(
            dealt.select("block", none("int").alias("kind"), none("binary").alias("keys"), none("binary").alias("answers"), "key", "text", "held_out")
        )
        .repartitionById(int(blocks), F.col("block").cast("int"))
        .sortWithinPartitions("block", F.col("kind").asc_nulls_last())
    )
    found = stored(arrow_rows(stream, _SCORED, _scores(depth)), "scores")
    top.destroy()

    # The end of a text is a token, too: one in each training text.
    training = figures["training"]
    tokens, types = corpus["tokens"] + training, corpus["types"] + (training > 0)
    per_token = F.log10(F.lit(float(tokens + types + 1)))
    n_tokens = F.col("n_words") + 1
    return found.select(
        F.col("key").alias(key),
        "held_out",
        n_tokens.alias("n_tokens"),
        (F.col("n_known") + F.lit(int(training > 0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + F.log10(F.lit(training + 1.0)) - n_tokens * per_token).alias("base_score"),
        "score",
        (-F.col("score") / F.log10(F.lit(2.0)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
