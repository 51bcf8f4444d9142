"""Operator 5: near-duplicate documents by a multi-index Hamming join of b-bit signatures.

A signature has ``POSITIONS`` minimum hashes, each cut to 16 bits. Two signatures that differ
in at most ``MAX_ERRORS`` positions agree, by pigeonhole, in one of ``CHUNKS`` chunks of four
positions but for at most one position. Every signature is therefore filed under each chunk
with each position left out in turn: all pairs under the distance meet under one of these keys.

Pairs of documents that meet are checked in two rounds that lose no link. First every document
is checked against the least one of its key. What that leaves apart, members of a key that are
in different components, is then checked pair by pair where their rarest shingles meet. Large
groups of copies so cost a check for each member, not for each pair, and equal sets are one row
from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cascadia.llm import flat
from cascadia.llm.common import arrow_rows, components, in_filter, key_filter, packed, stored

#: Signature: with a similarity of 0.85 a position differs with a probability of 0.15, and
#: more than 19 of 40 differ in one of 4 million pairs; the closer the pair, the rarer.
POSITIONS, CHUNKS, MAX_ERRORS = 40, 10, 19
WIDTH = POSITIONS // CHUNKS
#: Bytes of text worked off at once.
GROUP_BYTES = 1 << 21

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(20_11))
    a, b = rng.integers(0, 1 << 64, size=(2, n), dtype=np.uint64)
    return a | np.uint64(1), b


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * _MIX
    return x ^ (x >> np.uint64(29))


def shingles(texts: flat.Texts, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of all texts, one after another, and where each text begins.

    A-Z are lower-cased; shorter texts have one shingle, the whole sequence, and texts without
    a word none.
    """
    hashes, count = flat.text_words(texts)
    begin = np.cumsum(count) - count
    size = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    start = np.cumsum(size) - size
    # Place of each shingle's first word, and the words it has.
    first = np.arange(int(size.sum())) - np.repeat(start, size) + np.repeat(begin, size)
    length = np.repeat(np.minimum(count, words), size)
    out = length.astype(np.uint64) * _MIX
    for k in range(words):
        word = hashes[np.minimum(first + k, len(hashes) - 1)] if len(hashes) else hashes
        out = np.where(k < length, _mixed(out + word), out)
    return out, start


def signatures(hashes: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """b-bit minimum hashes of all texts, 16 bits each; texts without shingles get zeros."""
    a, b = _multipliers(POSITIONS)
    out = np.zeros((len(start), POSITIONS), dtype="<u2")
    some = np.flatnonzero(size)
    if len(some):
        for i in range(POSITIONS):
            least = np.minimum.reduceat(hashes * a[i] + b[i], start[some])
            out[some, i] = (_mixed(least) >> np.uint64(48)).astype("<u2")
    return out


def chunk_keys(sig: np.ndarray) -> np.ndarray:
    """Keys of every signature: each chunk with each of its positions left out."""
    keys = []
    for chunk in range(CHUNKS):
        for out in range(WIDTH):
            key = np.full(len(sig), chunk * WIDTH + out + 1, dtype=np.uint64) * _MIX
            for k in range(WIDTH):
                if k != out:
                    key = _mixed(key + sig[:, chunk * WIDTH + k].astype(np.uint64) + np.uint64(1))
            keys.append(key)
    return np.stack(keys, axis=1).view(np.int64)


def _features(docs: DataFrame, words: int) -> DataFrame:
    """Per row: key, size of its shingle set, a digest of the set, its signature."""
    schema = T.StructType(
        [
            docs.schema["key"],
            T.StructField("n_shingles", T.LongType()),
            T.StructField("set_key", T.BinaryType()),
            T.StructField("sig", T.BinaryType()),
        ]
    )

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        import xxhash

        for batch in batches:
            for part in flat.groups(batch["text"], GROUP_BYTES):
                hashes, start = shingles(batch["text"][part], words)
                size = np.diff(start, append=len(hashes))
                sets = [np.unique(x) for x in np.split(hashes, start[1:])]
                sig = signatures(hashes, start, size)
                yield {
                    "key": batch["key"][part],
                    "n_shingles": [len(s) for s in sets],
                    "set_key": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    "sig": [s.tobytes() for s in sig],
                }

    return arrow_rows(docs, schema, rows, flat=["text"])


def _sets(docs: DataFrame, members: DataFrame, words: int) -> tuple[DataFrame, Broadcast]:
    """``(key, shingles)``: the shingle set of each of ``members`` (key), from the texts ``docs``.

    Texts of other documents are left out at the scan by a filter, which also comes back, to be
    destroyed when the sets have been read.
    """
    schema = T.StructType([docs.schema["key"], T.StructField("shingles", T.ArrayType(T.LongType(), False))])
    bits = docs.sparkSession.sparkContext.broadcast(key_filter(members.select(F.col("key").cast("string")), "key"))

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            hit = np.flatnonzero(in_filter(bits.value, [str(k).encode() for k in batch["key"]])).tolist()
            keys, texts = [batch["key"][i] for i in hit], batch["text"].take(pa.array(hit, pa.int64()))
            for part in flat.groups(texts, GROUP_BYTES):
                hashes, start = shingles(texts[part], words)
                sets = [np.unique(x).view(np.int64) for x in np.split(hashes, start[1:])]
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                values = pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64))
                arrays = pa.ListArray.from_arrays(pa.array(offsets), values).cast(pa.list_(pa.field("element", pa.int64(), False)))
                yield {"key": keys[part], "shingles": arrays}

    picked = arrow_rows(docs, schema, rows, flat=["text"])
    return picked.join(members, "key", "left_semi").dropDuplicates(["key"]), bits


def _filed(reps: DataFrame) -> DataFrame:
    """``(key, rep)``: every signature under each of its keys."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("rep", T.LongType())])

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            for i in range(0, len(batch["rep"]), 10_000):
                sig = np.frombuffer(b"".join(batch["sig"][i : i + 10_000]), dtype="<u2").reshape(-1, POSITIONS)
                keys = chunk_keys(sig)
                yield {"key": pa.array(keys.ravel()), "rep": pa.array(np.repeat(np.array(batch["rep"][i : i + 10_000], dtype=np.int64), keys.shape[1]))}

    return arrow_rows(reps.select("rep", "sig"), schema, rows)


def _close(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs whose signatures are within the distance and whose set sizes allow the similarity."""
    side = lambda n: reps.select(F.col("rep").alias(n), F.col("n_shingles").alias(f"n_{n}"), F.col("sig").alias(f"sig_{n}"))
    both = (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    )
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("a", "b", "n_a", "n_b")])

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            if not batch["a"]:
                continue
            x, y = (np.frombuffer(b"".join(batch[n]), dtype="<u2").reshape(-1, POSITIONS) for n in ("sig_a", "sig_b"))
            near = np.flatnonzero((x != y).sum(axis=1) <= MAX_ERRORS).tolist()
            yield {n: [batch[n][i] for i in near] for n in ("a", "b", "n_a", "n_b")}

    return arrow_rows(both.select("a", "b", "n_a", "n_b", "sig_a", "sig_b"), schema, rows)


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs whose whole shingle sets reach the similarity."""
    pairs = stored(pairs, "near-pairs")
    members = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    found, bits = _sets(texts, members, words)
    sets = stored(found, "near-sets")
    bits.destroy()
    common = F.size(F.array_intersect("shingles_a", "shingles_b"))
    return (
        pairs.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("shingles_a")), "a")
        .join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("shingles_b")), "b")
        .where(100 * common >= percent * (F.col("n_a") + F.col("n_b") - common))
        .select("a", "b")
    )


def _rare_pairs(rest: DataFrame, reps: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs of documents in different parts that can be similar, by their rarest shingles.

    Ordered by how many of these documents have them, the rarest shingles of two similar sets
    meet: of n shingles the first n - percent * n / 100 + 1 suffice. Variants of one text that
    are similar but not enough each have rare shingles of their own, which come first, and so
    seldom meet, however many they are.
    """
    found, bits = _sets(texts, rest.select(F.col("rep").alias("key")), words)
    each = found.select(F.col("key").alias("rep"), F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    each = stored(each, "near-shingles")
    bits.destroy()
    often = each.groupBy("shingle").agg(F.count("*").alias("often")).where("often > 1")
    # Shingles that no other document has come first; they can't meet and are only counted.
    order = Window.partitionBy("rep").orderBy("often", "shingle")
    among = each.join(often, "shingle").withColumns(
        {"rank": F.row_number().over(order), "n_common": F.count("*").over(Window.partitionBy("rep"))}
    )
    place = F.col("n") - F.col("n_common") + F.col("rank")
    rare = among.where(place <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).select("shingle", "rep", "n", place.alias("place"))
    rare = stored(rare.join(rest, "rep"), "near-rare")
    other = rare.select("shingle", *(F.col(c).alias(f"{c}_b") for c in ("rep", "n", "place", "part")))
    # At the first shingle they share, what is left of both must still suffice.
    left = 1 + F.least(F.col("n") - F.col("place"), F.col("n_b") - F.col("place_b"))
    enough = (100 + percent) * left >= percent * (F.col("n") + F.col("n_b"))
    met = rare.join(other, "shingle").where((F.col("rep") < F.col("rep_b")) & (F.col("part") != F.col("part_b")) & enough)
    return met.select(F.col("rep").alias("a"), F.col("rep_b").alias("b")).distinct()


def near_documents(docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_shingles, component_id)`` for every row of ``docs``.

    Documents are linked when 100 times the size of the intersection of their sets of
    ``words``-word shingles is at least ``percent`` times that of the union; a component is
    named by its least key. Texts that are null or have no word link with nothing, as do rows
    with a null key, whose component is null. Rows with one key are one document and should
    have one text; with several, each row's text gets links under the common key. Keys are
    integers; other columns are ignored. ``percent`` must be 80 or more for the signature
    distance to hold (at 80, one of 80 thousand pairs of just that similarity exceeds it).
    Shingles are told apart by 64-bit hashes of their words (see ``flat``). Long texts are worked
    off whole; no rows give no rows.
    """
    if percent < 80:
        raise ValueError("the signature distance is made for a similarity of 80 percent or more")
    source = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    rows = stored(_features(source, words), "near-features")
    named = rows.where("n_shingles > 0 AND key IS NOT NULL")
    reps = stored(
        named.groupBy("set_key").agg(F.min(F.struct("key", "n_shingles", "sig")).alias("r")).select("set_key", F.col("r.key").alias("rep"), "r.n_shingles", "r.sig"),
        "near-reps",
    )
    filed = stored(_filed(reps), "near-filed")
    met = filed.groupBy("key").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most")
    shared = stored(filed.join(met.select("key", "least"), "key"), "near-shared")
    star = shared.where("rep > least").select(F.col("least").alias("a"), F.col("rep").alias("b")).distinct()
    unique = reps.dropDuplicates(["rep"])
    links = stored(_confirmed(_close(star, unique, percent), source, words, percent), "near-links")
    # Rows of one key with different sets share its component.
    same = named.join(reps.select("set_key", "rep"), "set_key").where("key <> rep").select(F.col("rep").alias("a"), F.col("key").alias("b")).distinct()
    links = stored(links.unionAll(same), "near-links")
    parts = stored(components(links, "a", "b"), "near-parts")

    # Members of a key that are still apart, without its least one, which all were checked with.
    label = F.coalesce("component", "rep")
    rest = shared.where("rep > least").join(parts.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", label.alias("part"))
    apart = rest.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("key")
    rest = stored(rest.join(apart, "key").select("rep", "part").distinct(), "near-rest")
    pairs = _rare_pairs(rest, unique, source, words, percent)
    more = _confirmed(_close(pairs, unique, percent), source, words, percent)
    parts = stored(components(links.unionAll(more), "a", "b"), "near-parts")
    return (
        rows.select("key", "n_shingles")
        .join(parts.withColumnRenamed("node", "key"), "key", "left")
        .select(F.col("key").alias(key), "n_shingles", F.coalesce("component", "key").alias("component_id"))
    )


def drop_near_documents(docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of every component of ``near_documents``, the one of least key; same columns.

    Rows that repeat key and text are one document and leave one row. Rows with a null key stay.
    """
    found = near_documents(docs, words, percent, key, text)
    kept = found.where(F.col(key) == F.col("component_id")).select(F.col(key).alias("id")).distinct()
    rows = packed(docs.where(F.col(key).isNotNull()), id=F.col(key).cast("long"), text=F.col(text))
    one = rows.join(kept, "id", "left_semi").dropDuplicates(["id", "text"])
    return one.select("row.*").unionByName(docs.where(F.col(key).isNull()))
