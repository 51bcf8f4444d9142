"""Operator 3: quality rules, with bands of compressibility.

Repetitive text compresses far better than prose, random strings far worse. A text is rejected
when the ratio of its zstandard size to its own leaves the band of its length, or when too many
of its fixed chunks leave the band of a chunk: the chunks find what a long text dilutes. What is
left after the last full chunk is one more chunk, with a band by its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cascadia.llm.common import arrow_rows

# White space and symbols of the base rules.
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

LEVEL = 3


class Band(NamedTuple):
    """Allowed ratios for texts of fewer than ``below`` bytes (None: all longer ones)."""

    below: int | None
    low: float
    high: float


#: The longer a text, the more of it repeats by chance, so both limits fall with its length.
#: Texts of under 128 bytes are too short to judge: headers outweigh them.
BANDS = (
    Band(128, 0.0, 9.0),
    Band(512, 0.40, 1.00),
    Band(2048, 0.33, 0.80),
    Band(16384, 0.27, 0.72),
    Band(None, 0.20, 0.68),
)
CHUNK = 2048
CHUNK_BAND = Band(None, 0.30, 0.78)
#: Limits of a last chunk by its length; a shorter one is judged with the bytes before it.
TAIL_BANDS = (
    Band(256, 0.45, 0.90),
    Band(512, 0.40, 0.80),
    Band(1024, 0.35, 0.74),
    Band(CHUNK, 0.30, 0.70),
)
LEAST_TAIL = 128
#: Share of a text's chunks, and of its full ones, that may lie outside the band.
MAX_BAD_CHUNKS = 0.25

FIELDS = {
    "n_words": T.LongType(),
    "word_chars": T.LongType(),
    "n_symbols": T.LongType(),
    "n_dup_lines": T.LongType(),
    "n_repeat_words": T.LongType(),
    "base_failed": T.BooleanType(),
    "ratio": T.DoubleType(),
    "n_chunks": T.LongType(),
    "n_bad_chunks": T.LongType(),
    "kept": T.BooleanType(),
}


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    if len(number) == len(words):
        return 0
    size = len(number)
    pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1]
    _, back, count = np.unique(pairs[:-1] * size + ids[2:], return_inverse=True, return_counts=True)
    again = count[back] > 1
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[k : len(again) + k] |= again
    return int(covered.sum())


def bad_tail(raw: bytes, compressor) -> bool:
    """Whether the chunk after the last full one leaves its band, alone or with the bytes before it."""
    rest = raw[len(raw) - len(raw) % CHUNK :]
    ratio = len(compressor.compress(raw[-CHUNK:])) / CHUNK
    if not CHUNK_BAND.low <= ratio <= CHUNK_BAND.high:
        return True
    if len(rest) < LEAST_TAIL:
        return False
    band = next(b for b in TAIL_BANDS if len(rest) < b.below)
    return not band.low <= len(compressor.compress(rest)) / len(rest) <= band.high


def measure(text: str | None, compressor) -> dict:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    seen: set[bytes] = set()
    dup_lines = 0
    for line in raw.split(b"\n"):
        if line and not line.isspace():
            if line in seen:
                dup_lines += 1
            seen.add(line)
    n, again = len(words), repeat_words(words)
    base_failed = n < MIN_WORDS or 100 * again > MAX_REPEAT_PERCENT * n
    ratio, bad, chunks, full_good = 1.0, 0, 0, True
    if raw:
        ratio = len(compressor.compress(raw)) / len(raw)
        chunks = len(raw) // CHUNK
        for i in range(chunks):
            size = len(compressor.compress(raw[i * CHUNK : (i + 1) * CHUNK]))
            bad += not CHUNK_BAND.low <= size / CHUNK <= CHUNK_BAND.high
        full_good = bad <= MAX_BAD_CHUNKS * chunks
        if chunks and len(raw) % CHUNK:
            chunks += 1
            bad += bad_tail(raw, compressor)
    band = next(b for b in BANDS if b.below is None or len(raw) < b.below)
    good = band.low <= ratio <= band.high and full_good and bad <= MAX_BAD_CHUNKS * chunks
    return {
        "n_words": n,
        "word_chars": len(text or "") - (len(raw) - len(raw.translate(None, SPACES))),
        "n_symbols": len(raw) - len(raw.translate(None, SYMBOLS)),
        "n_dup_lines": dup_lines,
        "n_repeat_words": again,
        "base_failed": base_failed,
        "ratio": ratio,
        "n_chunks": chunks,
        "n_bad_chunks": bad,
        "kept": good and not base_failed,
    }


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row the key, the figures of its whole text and the verdict ``kept``.

    A null or empty text has no words and fails the base rules. Rows stay as they are,
    repeated ones too; other columns are left out.
    """
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), *(T.StructField(k, t) for k, t in FIELDS.items())])

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        import zstandard

        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            found = [measure(t, compressor) for t in batch["text"]]
            yield {"key": batch["key"]} | {k: [m[k] for m in found] for k in FIELDS}

    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return arrow_rows(source, schema, rows).withColumnRenamed("key", key)
