"""Operator 6: order-preserving packing by dynamic programming.

Documents stay in the order of their key and form one stream of ids. Windows may end at a
document's end (free), at a sentence's end (a small penalty) and, in stretches without either,
at regular places inside a sentence (a larger one). Among all series of cuts the program finds
the one of least padding plus penalties: best(j) = penalty(j) + min over i of best(i) + padding
of the window from i to j. Padding falls linearly with the window's length, so the minimum over
the reachable i is the head of a monotone queue; windows of a power of two of ids need no
padding and are tried one by one.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cascadia.llm.common import arrow_rows
from cascadia.llm.tokens import CHUNKS, as_ids, library_encoder, token_bytes

WINDOW = 2048
#: Ids after which a task solves what it has gathered, at the next document's end.
BLOCK_IDS = 1 << 20
#: Penalties in ids of padding: for a cut between sentences, for one inside a sentence, and for
#: each window, so that padding isn't avoided by many small windows.
SENTENCE_CUT, INNER_CUT, WINDOW_COST = 4, 64, 64
#: Distance of the cuts allowed in a long stretch without a sentence's end.
INNER_STEP = 64


def cut_windows(places: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of the window ends of least total cost.

    ``places`` are the allowed cuts in ascending order, the first 0, the last the end of the
    stream, no two further apart than ``window``; ``penalty`` has the cost of cutting there.
    """
    n = len(places)
    if n > 1 and int(np.diff(places).max()) > window:
        raise ValueError("two allowed cuts lie further apart than the window")
    exact: dict[int, list[int]] = {}
    for size in (1 << p for p in range(window.bit_length()) if 1 << p < window):
        at = np.searchsorted(places, places - size)
        for j in np.flatnonzero((places >= size) & (places[np.minimum(at, n - 1)] == places - size)).tolist():
            exact.setdefault(j, []).append(int(at[j]))
    p, w = places.tolist(), penalty.tolist()
    best, back = [0] * n, [0] * n
    # The queue holds reachable starts i with rising best(i) + p(i).
    queue, value = deque([0]), [0] * n
    for j in range(1, n):
        end = p[j]
        while p[queue[0]] < end - window:
            queue.popleft()
        i = queue[0]
        cost = value[i] + window - end
        for k in exact.get(j, ()):
            if best[k] < cost or best[k] == cost and k < i:
                cost, i = best[k], k
        best[j] = cost = cost + w[j] + WINDOW_COST
        back[j] = i
        value[j] = v = cost + end
        while queue and value[queue[-1]] >= v:
            queue.pop()
        queue.append(j)
    cuts, j = [], n - 1
    while j > 0:
        cuts.append(p[j])
        j = back[j]
    return np.array(cuts[::-1], dtype=np.int64)


@functools.lru_cache(maxsize=4)
def _sentence_ends(path: str) -> np.ndarray:
    """Which ids end a sentence: a full stop, exclamation or question mark, or a line's end."""
    return np.array([b"\n" in t or t.rstrip(b"\"')").endswith((b".", b"!", b"?")) for t in token_bytes(path)])


def _places(ids: np.ndarray, ends_sentence: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Allowed cuts of one document, its start left out and its end included."""
    n = len(ids)
    cuts = np.flatnonzero(ends_sentence[ids]) + 1
    cuts = np.unique(np.append(cuts, n))
    gaps = np.diff(cuts, prepend=0)
    step = min(INNER_STEP, window)
    wide = np.flatnonzero(gaps > step)
    if len(wide):
        inner = np.concatenate([np.arange(cuts[i] - gaps[i] + step, cuts[i], step) for i in wide])
        places = np.concatenate([cuts, inner])
        cost = np.concatenate([np.full(len(cuts), SENTENCE_CUT), np.full(len(inner), INNER_CUT)])
        order = np.argsort(places, kind="stable")
        places, cost = places[order], cost[order]
    else:
        places, cost = cuts, np.full(len(cuts), SENTENCE_CUT)
    cost[-1] = 0
    return places, cost


def pack_documents(
    docs: DataFrame,
    path: str,
    end_id: int,
    window: int = WINDOW,
    key: str = "doc_id",
    text: str = "text",
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Pieces of all documents in windows of at most ``window`` ids.

    Each row is a piece: key, start (ids of its document before it), length, ids (little-endian
    32-bit), doc_tokens, sequence_id and offset in the sequence. Every id lies in exactly one
    piece. Documents keep the order of their key (null keys first, repeated keys by text);
    tasks take ranges of keys, and each range is solved in blocks of ``block_ids`` ids or more.
    A null text counts as empty and holds the end id alone. Other columns are ignored.
    """
    tail = struct.pack("<I", end_id)
    schema = T.StructType(
        [
            T.StructField(key, T.LongType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def solve(block: list[tuple], first_sequence: int) -> tuple[dict, int]:
        keys = [b[0] for b in block]
        sizes = np.array([len(b[1]) // 4 for b in block], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        places = np.concatenate([[0], *(b[2] + s for b, s in zip(block, starts))])
        penalty = np.concatenate([[0], *(b[3] for b in block)])
        cuts = cut_windows(places, penalty, window)
        opens = np.concatenate([[0], cuts[:-1]])
        edges = np.union1d(np.concatenate([opens, starts]), [places[-1]])
        begin, length = edges[:-1], np.diff(edges)
        doc = np.searchsorted(starts, begin, side="right") - 1
        sequence = np.searchsorted(opens, begin, side="right") - 1
        start = begin - starts[doc]
        ids = [block[d][1][4 * s : 4 * (s + n)] for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist())]
        out = {
            key: [keys[d] for d in doc],
            "start": start.tolist(),
            "length": length.tolist(),
            "ids_crc32": [zlib.crc32(x) for x in ids],
            "doc_tokens": sizes[doc].tolist(),
            "sequence_id": (first_sequence + sequence).tolist(),
            "offset": (begin - opens[sequence]).tolist(),
            "ids": ids,
        }
        return out, first_sequence + len(cuts)

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        encoder = library_encoder(path)
        ends_sentence = _sentence_ends(path)
        sequence = TaskContext.get().partitionId() << 40
        block, held = [], 0
        for batch in batches:
            for k, ids in zip(batch["k"], encoder.encode(batch["t"])):
                ids += tail
                block.append((k, ids, *_places(as_ids(ids), ends_sentence, window)))
                held += len(ids) // 4
                if held >= block_ids:
                    out, sequence = solve(block, sequence)
                    yield out
                    block, held = [], 0
        if block:
            yield solve(block, sequence)[0]

    ordered = (
        docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
        .repartitionByRange("k")
        .sortWithinPartitions("k", "t")
    )
    return arrow_rows(ordered, schema, rows, flat=["t"], store=CHUNKS)
