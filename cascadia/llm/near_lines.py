"""Operator 4: near-duplicate lines by a deletion-neighbourhood join.

Lines are compared as sequences of words. Lines of ``MIN_EDIT_WORDS`` words or more may differ
by one edit (a word replaced, inserted or deleted), shorter ones must agree. Two lines within
one edit share a variant: a line itself or the line without one of its words. Variants are
hashed keys, and equal keys are joined; the texts of each match are compared in the end.

Two kinds of keys make every group of equal variants one of true neighbours, so that the
earliest line of a group stands for all its pairs and none has to be listed:

* *replaced*: the line without word i, with i and its length in the key. Lines that share it
  differ in word i alone.
* *inserted*: the line without a word against whole lines. A group has one whole line.

Only lines that can have a neighbour emit variants: if two lines are within one edit, their
first halves or their second halves are equal. Lines that share neither with another are left
out by two hashed keys for each of the two lengths a pair may have.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cascadia.llm import flat
from cascadia.llm.common import arrow_rows, in_filter, key_filter, packed, stored

#: From this length on a line may differ by one word; 8 words make that a similarity of 7/8.
MIN_EDIT_WORDS = 8

_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Inverse of the base modulo 2**64: moves words one place to the front.
_INVERSE = np.uint64(pow(int(_MIX), -1, 1 << 64))

LINES = T.StructType(
    [
        T.StructField("doc", T.LongType()),
        T.StructField("tie", T.LongType()),
        T.StructField("line", T.IntegerType()),
        T.StructField("h", T.BinaryType()),
        T.StructField("halves", T.ArrayType(T.LongType(), False)),
    ]
)


def line_words(line: str) -> list[bytes]:
    """The words of a line: split at ASCII white space, A-Z lower-cased."""
    return line.encode("utf-8", "surrogatepass").lower().split()


def within_one_edit(a: list[bytes], b: list[bytes]) -> bool:
    """Whether a word replaced, inserted or deleted, or nothing, makes ``a`` from ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def _ones(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return out


class _Hashed:
    """Polynomial hashes of the words of many lines, all in one array."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        """``words`` are the hashes of all words, ``counts`` says how many each line has."""
        self.n = counts
        self.words = words
        most = int(self.n.max()) + 2 if len(counts) else 2
        self.power, self.inverse = (np.cumprod(_ones(most, base), dtype=np.uint64) for base in (_MIX, _INVERSE))
        self.start = np.cumsum(self.n) - self.n
        place = np.arange(len(self.words)) - np.repeat(self.start, self.n)
        # sums[k] - sums[start] is the hash of a line's first words, each times a power of its place.
        self.sums = np.zeros(len(self.words) + 1, dtype=np.uint64)
        np.cumsum(self.words * self.power[place], dtype=np.uint64, out=self.sums[1:])
        self.place = place

    def span(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes of words first to last of every line, wherever they stand in it."""
        return (self.sums[self.start + last] - self.sums[self.start + first]) * self.inverse[first]

    def halves(self) -> np.ndarray:
        """Four keys a line: the first and the second half, as shorter and as longer line of a pair.

        Halves are counted in the shorter line: its first ``short // 2`` words, and the rest.
        """
        keys = []
        for short in (self.n, self.n - 1):
            h = short // 2
            for tag, x in ((1, self.span(0 * h, h)), (2, self.span(self.n - (short - h), self.n))):
                keys.append(_mixed(_mixed(x) + (3 * short + tag).astype(np.uint64)))
        return np.stack(keys, axis=1).view(np.int64)

    def whole(self) -> np.ndarray:
        """Key of each whole line, comparable with ``without``."""
        return self.sums[self.start + self.n] - self.sums[self.start]

    def without(self) -> np.ndarray:
        """For every word of every line the hash of its line without that word."""
        at = np.arange(len(self.words))
        start, n = np.repeat(self.start, self.n), np.repeat(self.n, self.n)
        before = self.sums[at] - self.sums[start]
        after = self.sums[start + n] - self.sums[at + 1]
        return before + after * _INVERSE


#: Bytes of text worked off at once.
GROUP_BYTES = 1 << 20


class _Lines:
    """The lines with a word of a run of texts: whose, which, the hashes of their words, a digest."""

    def __init__(self, texts: flat.Texts):
        self.raw, self.offsets = flat.text_bytes(texts)
        data = flat.folded(self.raw)
        start, size, counts = flat.words(data, self.offsets)
        words = flat.span_hashes(data, start, size)
        self.breaks = np.flatnonzero(self.raw == 0x0A)
        owner = np.repeat(np.arange(len(counts)), counts)
        number = np.searchsorted(self.breaks, start) - np.searchsorted(self.breaks, self.offsets[:-1])[owner]
        first = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(number, prepend=-1) != 0))
        self.owner, self.number, self.at = owner[first], number[first].astype(np.int32), start[first]
        n = np.diff(np.append(first, len(words)))
        self.hashed = _Hashed(words, n)
        self.digests = np.empty((len(n), 2), dtype=np.uint64)
        if len(n):
            self.digests[:, 0] = _mixed(self.hashed.whole() + n.astype(np.uint64))
            placed = flat.mixed(words + self.hashed.place.astype(np.uint64) * _MIX)
            self.digests[:, 1] = flat.mixed(np.add.reduceat(placed, self.hashed.start) + n.astype(np.uint64))

    def __len__(self) -> int:
        return len(self.owner)

    def halves(self, min_words: int) -> pa.Array:
        """The half keys of every line of so many words, null for the others."""
        long = self.hashed.n >= min_words
        some = _Hashed(self.hashed.words[np.repeat(long, self.hashed.n)], self.hashed.n[long])
        keys = some.halves() if long.any() else np.empty((0, 4), dtype=np.int64)
        places = np.concatenate([[0], np.cumsum(np.where(long, keys.shape[1], 0))]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(places), pa.array(keys.ravel()), mask=pa.array(~long))
        return lists.cast(pa.list_(pa.field("element", pa.int64(), False)))

    def text(self, i: int) -> str:
        """Line ``i`` as it stands."""
        k = int(np.searchsorted(self.breaks, self.at[i]))
        begin, end = int(self.offsets[self.owner[i]]), int(self.offsets[self.owner[i] + 1])
        if k:
            begin = max(begin, int(self.breaks[k - 1]) + 1)
        if k < len(self.breaks):
            end = min(end, int(self.breaks[k]))
        return self.raw[begin:end].tobytes().decode()


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """One row per line with a word: its place, a digest of its words, and its half keys
    if it has ``min_words`` words."""

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for part in flat.groups(batch["text"], GROUP_BYTES):
                lines = _Lines(batch["text"][part])
                owner = pa.array(lines.owner + part.start)
                yield {
                    "doc": batch["doc"].take(owner),
                    "tie": batch["tie"].take(owner),
                    "line": pa.array(lines.number),
                    "h": flat.binary(lines.digests),
                    "halves": lines.halves(min_words),
                }

    return arrow_rows(docs, LINES, rows, flat=["doc", "tie", "text"])


def _hits(docs: DataFrame, again: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(doc, tie, line, h, text)`` of the lines whose digest is in ``again`` or ``wanted``, and a
    few more; with the text for those in ``wanted``. The rows are stored.

    Bitmaps leave out nearly all other lines at the scan. The joins that follow are exact, so
    full bitmaps would cost time but change nothing.
    """
    schema = T.StructType([*LINES.fields[:4], T.StructField("text", T.StringType())])
    bits = docs.sparkSession.sparkContext.broadcast((key_filter(again, "h"), key_filter(wanted, "h")))

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for part in flat.groups(batch["text"], GROUP_BYTES):
                lines = _Lines(batch["text"][part])
                keys = [d.tobytes() for d in lines.digests]
                in_again, in_wanted = (in_filter(b, keys) for b in bits.value)
                some = np.flatnonzero(in_again | in_wanted)
                owner = pa.array(lines.owner[some] + part.start)
                yield {
                    "doc": batch["doc"].take(owner),
                    "tie": batch["tie"].take(owner),
                    "line": pa.array(lines.number[some]),
                    "h": flat.binary(lines.digests[some]),
                    "text": [lines.text(i) if in_wanted[i] else None for i in some.tolist()],
                }

    out = stored(arrow_rows(docs, schema, rows, flat=["doc", "tie", "text"]), "lines-hits")
    bits.destroy()
    return out


def _variants(texts: DataFrame) -> DataFrame:
    """``(kind, key, sid)``: the hashed keys of every line.

    Kind 0: the line itself; 1: without a word, to meet whole lines; 2: without word i, with i.
    """
    schema = T.StructType(
        [T.StructField("kind", T.IntegerType()), T.StructField("key", T.LongType()), T.StructField("sid", T.LongType())]
    )

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for a in range(0, len(batch["sid"]), 2000):
                sid = np.array(batch["sid"][a : a + 2000], dtype=np.int64)
                lines = _Hashed(*flat.text_words(batch["text"][a : a + 2000]))
                n = np.repeat(lines.n, lines.n).astype(np.uint64)
                whole = _mixed(lines.whole() + lines.n.astype(np.uint64))
                without = lines.without()
                meet = _mixed(without + n - np.uint64(1))
                same = _mixed(_mixed(without + n) + (lines.place + 1).astype(np.uint64))
                many = np.repeat(sid, lines.n)
                yield {
                    "kind": pa.array(np.repeat(np.arange(3, dtype=np.int32), [len(sid), len(many), len(many)])),
                    "key": pa.array(np.concatenate([whole, meet, same]).view(np.int64)),
                    "sid": pa.array(np.concatenate([sid, many, many])),
                }

    return arrow_rows(texts, schema, rows)


def _tie(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def near_lines(docs: DataFrame, min_words: int = MIN_EDIT_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every line that has an earlier equal or near line, with the earliest such line found.

    Returns ``(doc, tie, line, first_doc, first_line, n_edits)``: the document's key, a digest
    of its text, the line's number from 0, and the same of the earlier line; ``n_edits`` is 0
    for equal words, else 1. Lines are those between ``\\n``; lines without a word never count.
    Earlier means a smaller (key, digest, number), null keys first. An equal line is reported
    with its first occurrence; a first occurrence is reported when one within an edit lies
    before it. Rows with equal key and text are one document, whose lines are not each other's
    duplicates. Null and empty texts have no lines. Keys are integers; other columns are ignored.
    """
    source = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"), _tie(text).alias("tie"))
    place = F.struct("doc", "tie", "line")
    distinct = stored(
        _lines(source, min_words)
        .groupBy("h")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"), F.first("halves").alias("halves"))
        .select("h", "first.*", F.col("first").eqNullSafe(F.col("last")).alias("once"), "halves"),
        "lines",
    )

    # Lines that may have a neighbour, numbered in their order. The numbers are made in the tasks
    # that sort: files that are read again come in the order of their sizes.
    filed = distinct.where("halves IS NOT NULL").select("h", F.explode("halves").alias("half"))
    shared = filed.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    hopeful = filed.join(shared, "half", "left_semi").select("h").distinct()
    some = distinct.join(hopeful, "h", "left_semi").select("h", "doc", "tie", "line")
    some = stored(some.orderBy("doc", "tie", "line").withColumn("sid", F.monotonically_increasing_id()), "lines-numbered")
    again = distinct.where("NOT once").select("h", F.struct("doc", "tie", "line").alias("first"))
    hits = _hits(source, again, some).withColumn("at", place)
    wanted = some.select("h", "sid", place.alias("first"))
    texts = hits.where("text IS NOT NULL").join(wanted, "h").where(F.col("at").eqNullSafe(F.col("first")))
    texts = stored(texts.select("sid", "text").dropDuplicates(["sid"]), "lines-texts")
    variants = stored(_variants(texts), "lines-variants")

    group = variants.where("kind = 2").groupBy("key").agg(F.min("sid").alias("first"), F.max("sid").alias("last")).where("first < last")
    replaced = variants.where("kind = 2").join(group.select("key", "first"), "key").where("sid > first").select("sid", "first")
    whole = variants.where("kind = 0").select("key", F.col("sid").alias("other"))
    inserted = variants.where("kind = 1").join(whole, "key").select(F.greatest("sid", "other").alias("sid"), F.least("sid", "other").alias("first"))
    pairs = replaced.unionAll(inserted).groupBy("sid").agg(F.min("first").alias("first"))
    near = _verified(pairs, texts)

    named = lambda n: some.select(F.col("sid").alias(n), F.struct("doc", "tie", "line").alias(f"at_{n}"))
    edited = (
        near.join(named("sid"), "sid")
        .join(named("first"), "first")
        .select("at_sid.*", F.col("at_first.doc").alias("first_doc"), F.col("at_first.line").alias("first_line"), F.lit(1).alias("n_edits"))
    )
    equal = (
        hits.select("h", "at")
        .join(again, "h")
        .where(~F.col("at").eqNullSafe(F.col("first")))
        .select("at.*", F.col("first.doc").alias("first_doc"), F.col("first.line").alias("first_line"), F.lit(0).alias("n_edits"))
    )
    return equal.unionAll(edited)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose lines are within one edit of each other."""
    schema = T.StructType([T.StructField("sid", T.LongType()), T.StructField("first", T.LongType())])
    both = pairs.join(texts.select("sid", F.col("text").alias("a")), "sid").join(
        texts.select(F.col("sid").alias("first"), F.col("text").alias("b")), "first"
    )

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            good = [i for i, (a, b) in enumerate(zip(batch["a"], batch["b"])) if within_one_edit(line_words(a), line_words(b))]
            yield {n: [batch[n][i] for i in good] for n in ("sid", "first")}

    return arrow_rows(both.select("sid", "first", "a", "b"), schema, rows)


def drop_near_lines(docs: DataFrame, min_words: int = MIN_EDIT_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the lines that ``near_lines`` reports; same columns.

    The other lines keep their order and their text. Documents that lose lines and keep none
    with a word are left out; all others stay, also null and empty ones, and repeated rows.
    A column ``n_chars`` is set to the new length.
    """
    found = near_lines(docs, min_words, key, text)
    lost = found.groupBy(F.col("doc").alias("lost_doc"), F.col("tie").alias("lost_tie")).agg(F.collect_set("line").alias("lost"))
    rows = packed(docs, doc=F.col(key).cast("long"), tie=_tie(text), text=F.col(text))
    joined = rows.join(lost, F.col("doc").eqNullSafe(F.col("lost_doc")) & (F.col("tie") == F.col("lost_tie")), "left")
    kept = F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains("lost", i))
    whole = F.col("lost").isNull()
    changed = joined.withColumn("new", F.when(whole, F.col("text")).otherwise(F.array_join(kept, "\n")))
    changed = changed.where(whole | F.col("new").rlike(r"[^\x20\x09-\x0D]"))
    out = {text: F.col("new")}
    if "n_chars" in docs.columns:
        n = F.when(whole, F.col("row.n_chars")).otherwise(F.length("new"))
        out["n_chars"] = n.cast(docs.schema["n_chars"].dataType)
    return changed.select(*[out.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
