"""Operator 2: token files with Elias-Fano document boundaries.

A file holds the ids of a range of documents, one after another, and two monotone sequences:
the end of each document in ids and the document keys. Both are stored as Elias-Fano codes
(about 2 + log2(span / documents) bits an entry), and ``select`` finds any entry through
sampled positions of the ones, so no table of 64-bit offsets exists on disk or in memory.

Layout of a file, all numbers little-endian::

    magic (8 bytes), id width in bytes (8 bytes)
    ids
    code of the document ends, code of the keys: low bits, high bits, samples
    footer: FOOTER, then its length (4 bytes), then the magic again

Tasks write files under names of their own; the manifest (a Parquet table beside them) names
the files that count, so an attempt that died or ran twice leaves nothing that is read.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cascadia.llm.common import arrow_rows
from cascadia.llm.tokens import CHUNKS, as_ids, library_encoder, vocabulary

MAGIC = b"CTOKENS1"
#: Every so many ones of the high bits have their position stored.
SAMPLE = 256
#: Bytes of ids read or handed on at once.
BLOCK_BYTES = 8 << 20

MANIFEST = T.StructType(
    [
        T.StructField("part", T.LongType()),
        T.StructField("file", T.StringType()),
        T.StructField("n_docs", T.LongType()),
        T.StructField("n_ids", T.LongType()),
    ]
)


class EliasFano(NamedTuple):
    """A non-decreasing sequence of ``n`` numbers from 0."""

    n: int
    low_bits: int
    low: np.ndarray
    high: np.ndarray
    samples: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        shifts = np.arange(bits, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        flags[ones] = 1
        return cls(n, bits, low, np.packbits(flags, bitorder="little"), ones[::SAMPLE].astype("<u4"))

    def _low(self, first: int, last: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(last - first, dtype=np.uint64)
        a, b = first * self.low_bits, last * self.low_bits
        flags = np.unpackbits(self.low[a // 8 : -(-b // 8)], bitorder="little")[a % 8 : a % 8 + b - a]
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return (flags.reshape(-1, self.low_bits).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)

    def select(self, first: int, last: int | None = None) -> np.ndarray:
        """Entries ``first`` to ``last`` (exclusive; one entry without it), read from the nearest sample."""
        last = first + 1 if last is None else last
        if first >= last:
            return np.empty(0, dtype=np.uint64)
        block = first // SAMPLE
        at = int(self.samples[block])
        byte = at // 8
        need = last - block * SAMPLE
        end_block = -(-last // SAMPLE)
        end = int(self.samples[end_block]) // 8 + 1 if end_block < len(self.samples) else len(self.high)
        flags = np.unpackbits(self.high[byte:end], bitorder="little")
        flags[: at - 8 * byte] = 0
        ones = np.flatnonzero(flags)[first - block * SAMPLE : need] + 8 * byte
        high = (ones - np.arange(first, last)).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._low(first, last)

    def parts(self) -> list[bytes]:
        return [self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()]


class TokenFile:
    """Random access to one file through ``select``; keeps only the two codes in memory."""

    def __init__(self, uri: str):
        system, path = fs.FileSystem.from_uri(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(12, size - 12)
        length = struct.unpack("<I", tail[:4])[0]
        if tail[4:] != MAGIC:
            raise ValueError(f"{uri} is no complete token file")
        meta = json.loads(self.file.read_at(length, size - 12 - length))
        self.width, self.n_docs, self.n_ids = meta["width"], meta["n_docs"], meta["n_ids"]
        self.key_base, self.null_keys = meta["key_base"], meta["null_keys"]
        self.ends, self.keys = (self._code(c) for c in meta["codes"])

    def _code(self, c: dict) -> EliasFano:
        def load(span: list[int], kind: str) -> np.ndarray:
            return np.frombuffer(self.file.read_at(span[1], span[0]), dtype=kind)

        return EliasFano(c["n"], c["low_bits"], load(c["low"], "u1"), load(c["high"], "u1"), load(c["samples"], "<u4"))

    def offset(self, i: int) -> int:
        """Ids of the file before its document ``i``."""
        return int(self.ends.select(i - 1)[0]) if i else 0

    def offsets(self, first: int, last: int) -> np.ndarray:
        """Boundaries of documents ``first`` to ``last`` (exclusive): one more than documents."""
        head = [self.offset(first)]
        return np.concatenate([np.array(head, dtype=np.int64), self.ends.select(first, last).astype(np.int64)])

    def key(self, i: int) -> int | None:
        return None if i < self.null_keys else int(self.keys.select(i - self.null_keys)[0]) + self.key_base

    def ids(self, first: int, last: int) -> np.ndarray:
        raw = self.file.read_at((last - first) * self.width, 16 + first * self.width)
        return np.frombuffer(raw, dtype=f"<u{self.width}")

    def document(self, i: int) -> np.ndarray:
        a, b = (int(x) for x in self.offsets(i, i + 1))
        return self.ids(a, b)


def _write(uri: str, width: int, docs: Iterator[tuple[int | None, bytes]]) -> tuple[int, int]:
    """Write one file; memory holds the boundaries and keys, not the ids."""
    system, path = fs.FileSystem.from_uri(uri)
    ends, keys, nulls, total = [], [], 0, 0
    with system.open_output_stream(path) as out:
        out.write(MAGIC + struct.pack("<Q", width))
        for key, packed in docs:
            total += len(packed) // 4
            ends.append(total)
            if key is None:
                nulls += 1
            else:
                keys.append(key)
            out.write(packed if width == 4 else as_ids(packed).astype(f"<u{width}").tobytes())
        base = keys[0] if keys else 0
        codes, at = [], 16 + total * width
        for code in (EliasFano.of(np.array(ends)), EliasFano.of(np.array([k - base for k in keys], dtype=np.uint64))):
            spans = []
            for part in code.parts():
                out.write(part)
                spans.append([at, len(part)])
                at += len(part)
            codes.append({"n": code.n, "low_bits": code.low_bits, **dict(zip(("low", "high", "samples"), spans))})
        meta = {"width": width, "n_docs": len(ends), "n_ids": total, "key_base": base, "null_keys": nulls, "codes": codes}
        footer = json.dumps(meta).encode()
        out.write(footer + struct.pack("<I", len(footer)) + MAGIC)
    return len(ends), total


def write_token_files(
    docs: DataFrame, folder: str, path: str, end_id: int | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode every whole text and write token files under ``folder``; returns the manifest.

    Documents lie in ascending order of the integer ``key``, null keys first, repeated keys
    ordered by their text; a file holds a range of keys. A null text counts as empty; with
    ``end_id`` each document ends with that id. Ids take two bytes where the vocabulary
    allows. Other columns are ignored; an empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    top = max([*vocabulary(path)["model"]["vocab"].values(), *(t["id"] for t in vocabulary(path)["added_tokens"]), end_id or 0])
    width = 2 if top < 1 << 16 else 4
    tail = b"" if end_id is None else struct.pack("<I", end_id)

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        encoder = library_encoder(path)
        context = TaskContext.get()
        part = context.partitionId()
        uri = f"{folder}/part-{part:06d}-{context.taskAttemptId()}.tokens"

        def pairs(first: dict) -> Iterator[tuple[int | None, bytes]]:
            for batch in _chain(first, batches):
                yield from zip(batch["k"], (ids + tail for ids in encoder.encode(batch["t"])))

        for first in batches:
            if first["k"]:
                n_docs, n_ids = _write(uri, width, pairs(first))
                yield {"part": [part], "file": [uri], "n_docs": [n_docs], "n_ids": [n_ids]}
                return

    _make_folder(folder)
    ordered = (
        docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
        .repartitionByRange("k")
        .sortWithinPartitions("k", "t")
    )
    arrow_rows(ordered, MANIFEST, rows, flat=["t"], store=CHUNKS).write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def _chain(first: dict, rest: Iterator[dict]) -> Iterator[dict]:
    yield first
    yield from rest


def _make_folder(folder: str) -> None:
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file, with the number of ids in all files before it."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").withColumn(
        "base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))
    )


def read_token_files(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """Every document of the files: key, start (ids of all documents before it), n_tokens and
    its ids as little-endian 32-bit numbers. Starts come from the Elias-Fano codes."""
    schema = T.StructType(
        [
            T.StructField(key, T.LongType()),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for uri, base in zip(batch["file"], batch["base"]):
                source = TokenFile(uri)
                first = 0
                while first < source.n_docs:
                    last = min(source.n_docs, first + 4096)
                    ends = source.offsets(first, last)
                    # As many documents as fit the block, one at least.
                    room = int(np.searchsorted(ends, ends[0] + BLOCK_BYTES // 4, side="right")) - 1
                    last = first + max(1, min(last - first, room))
                    ends = ends[: last - first + 1]
                    ids = source.ids(int(ends[0]), int(ends[-1])).astype("<u4")
                    nulls = max(0, min(last, source.null_keys) - first)
                    keys = source.keys.select(first + nulls - source.null_keys, last - source.null_keys) if last > source.null_keys else []
                    cuts = (ends - ends[0]).tolist()
                    yield {
                        key: [None] * nulls + [int(k) + source.key_base for k in keys],
                        "start": (base + ends[:-1]).tolist(),
                        "n_tokens": np.diff(ends).tolist(),
                        "ids": [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])],
                    }
                    first = last

    files = read_manifest(spark, folder).select("part", "file", "base")
    return arrow_rows(files.repartition(max(1, files.count()), "part"), schema, rows)
