"""Operator 10: a quality classifier by importance resampling.

Two generative models over hashed word n-grams, one of the target (labelled documents that are
good) and one of all raw text, give every n-gram a log ratio. A document's importance comes
from the ratios of its n-grams; a logistic fit on labelled documents that the target model
hasn't seen turns it into log-odds. A second ratio and fit tell toxic documents from the others:
toxic words are few among ordinary ones and come with many endings and marks, so it looks at the
beginnings of words, and its cut is chosen on labelled documents that neither has seen. A
document's log-odds are the lower of both verdicts. Documents are then sampled without replacement by Gumbel
top-k: each gets its log-odds plus keyed Gumbel noise, and the k highest stay, where k is the
number of documents that are more likely good than not.

Counts cover every document. They travel as fixed slices of two count vectors, so their size
depends on the model alone; only the labelled sample (``LABELS`` rows at most) and the model
(``sum of 2**BITS`` numbers) pass through the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cascadia.llm import flat
from cascadia.llm.common import arrow_rows, packed, stored

#: Buckets of single words and of word pairs, as powers of two.
BITS = (20, 18)
SIZE = sum(1 << b for b in BITS)
#: Slices of the count vectors, the unit in which tasks hand on their counts.
SLICES = 80
#: Bytes of a word that count as its beginning, and buckets of beginnings as a power of two.
START_BYTES, START_BITS = 5, 18
STARTS = 1 << START_BITS
#: Added to every count: a bucket that the target is expected to fill less often says little.
SMOOTHING = 2.0
#: Labelled documents used at most (those of least key hash); the rest are scored like all others.
LABELS = 100_000
#: Log ratios under these are evidence against a document and are summed on their own.
WEAK, STRONG = -0.7, -1.5
#: Log ratios of beginnings over this are evidence that a document is toxic.
TOXIC = 1.0
#: How much the share of other documents lost counts against the share of toxic ones found.
LOST_WEIGHT = 4.0
#: Scale of the Gumbel noise in log-odds.
TEMPERATURE = 0.05
GROUP_BYTES = 1_000_000

FEATURES = ("weak_mean", "weak_log", "strong_log", "word_mean", "pair_mean", "pair_weak", "n_log")
TOXIC_FEATURES = ("toxic_top", "toxic_log", "toxic_mean", "toxic_weak")

_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(33))


def ngrams(texts: flat.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the words and of the pairs of neighbours of all texts, and whose they are.

    Words are split at ASCII white space, A-Z lower-cased; a null text has none.
    """
    h, count = flat.text_words(texts)
    owner = np.repeat(np.arange(len(texts)), count)
    words = (_mixed(h) >> np.uint64(64 - BITS[0])).astype(np.int64)
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    pairs = (_mixed(_mixed(h[inner]) + h[inner + 1]) >> np.uint64(64 - BITS[1])).astype(np.int64) + (1 << BITS[0])
    return words, owner, pairs, owner[inner]


def starts(texts: flat.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the beginnings of all words, and whose they are; words as in ``ngrams``."""
    raw, offsets = flat.text_bytes(texts)
    data = flat.folded(raw)
    start, size, count = flat.words(data, offsets)
    h = flat.span_hashes(data, start, np.minimum(size, START_BYTES))
    return (_mixed(h) >> np.uint64(64 - START_BITS)).astype(np.int64), np.repeat(np.arange(len(texts)), count)


def _counts(docs: DataFrame, target_keys: np.ndarray, toxic_keys: np.ndarray | None = None) -> np.ndarray:
    """Counts of all buckets in raw text (first row) and in the target's documents (second).

    With ``toxic_keys`` the counts of word beginnings follow; their target is the toxic documents.
    """
    schema = T.StructType([T.StructField("slice", T.IntegerType()), T.StructField("counts", T.BinaryType())])
    size = SIZE if toxic_keys is None else SIZE + STARTS
    width = -(-size // SLICES)

    def parts(total: dict[int, np.ndarray]) -> dict:
        return {"slice": list(total), "counts": [zlib.compress(c.tobytes(), 1) for c in total.values()]}

    def count(batches: Iterator[dict]) -> Iterator[dict]:
        total = np.zeros((2, width * SLICES), dtype=np.int64)
        raw, target = total
        seen = False
        for batch in batches:
            seen = True
            keys = np.array([-1 if k is None else k for k in batch["key"]], dtype=np.int64)
            keyed = np.array([k is not None for k in batch["key"]], dtype=bool)
            known = np.isin(keys, target_keys) & keyed
            for part in flat.groups(batch["text"], GROUP_BYTES):
                words, w_owner, pairs, p_owner = ngrams(batch["text"][part])
                good = known[part]
                for bucket, owner in ((words, w_owner), (pairs, p_owner)):
                    raw += np.bincount(bucket, minlength=len(raw))
                    target += np.bincount(bucket[good[owner]], minlength=len(raw))
                if toxic_keys is not None:
                    toxic = (np.isin(keys, toxic_keys) & keyed)[part]
                    start, owner = starts(batch["text"][part])
                    raw[SIZE:size] += np.bincount(start, minlength=STARTS)
                    target[SIZE:size] += np.bincount(start[toxic[owner]], minlength=STARTS)
        if seen:
            yield parts({i: total[:, i * width : (i + 1) * width] for i in range(SLICES)})

    def add(batches: Iterator[dict]) -> Iterator[dict]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, packed in zip(batch["slice"], batch["counts"]):
                c = np.frombuffer(zlib.decompress(packed), dtype=np.int64).reshape(2, width)
                total[i] = total[i] + c if i in total else c
        yield parts(total)

    summed = arrow_rows(arrow_rows(docs, schema, count, flat=["text"]).repartition(SLICES // 4, "slice"), schema, add)
    out = np.zeros((2, width * SLICES))
    for row in summed.toLocalIterator():
        out[:, row["slice"] * width : (row["slice"] + 1) * width] = np.frombuffer(zlib.decompress(row["counts"]), dtype=np.int64).reshape(2, width)
    return out[:, :size]


def _log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    expected = raw * (target.sum() / max(1.0, raw.sum()))
    return np.log((target + SMOOTHING) / (expected + SMOOTHING))


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log of the target's share of each bucket over that of raw text, smoothed, by n-gram order."""
    out = np.zeros(SIZE, dtype=np.float32)
    first = 0
    for bits in BITS:
        part = slice(first, first + (1 << bits))
        first += 1 << bits
        out[part] = _log_ratio(raw[part], target[part])
    return out


def features(texts: flat.Texts, ratios: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per text; a text without words gets zeros."""
    words, w_owner, pairs, p_owner = ngrams(texts)
    x, y = ratios[words].astype(np.float64), ratios[pairs].astype(np.float64)

    def summed(owner: np.ndarray, values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=values, minlength=len(texts))

    n, m = (np.maximum(1, np.bincount(o, minlength=len(texts))) for o in (w_owner, p_owner))
    weak = summed(w_owner, np.minimum(x - WEAK, 0))
    strong = summed(w_owner, np.minimum(x - STRONG, 0))
    return np.stack(
        [
            weak / n,
            np.log1p(-weak),
            np.log1p(-strong),
            summed(w_owner, x) / n,
            summed(p_owner, y) / m,
            summed(p_owner, np.minimum(y - WEAK, 0)) / n,
            np.log(n),
        ],
        axis=1,
    )


def toxic_features(texts: flat.Texts, ratios: np.ndarray) -> np.ndarray:
    """One row of ``TOXIC_FEATURES`` per text; a text without words gets zeros."""
    start, owner = starts(texts)
    x = ratios[start].astype(np.float64)
    n = np.maximum(1, np.bincount(owner, minlength=len(texts)))
    top = np.zeros(len(texts))
    np.maximum.at(top, owner, x)
    strong = np.bincount(owner, weights=np.maximum(x - TOXIC, 0), minlength=len(texts))
    weak = np.bincount(owner, weights=np.minimum(x, 0), minlength=len(texts))
    return np.stack([top, np.log1p(strong), strong / n, weak / n], axis=1)


def _scored(docs: DataFrame, ratios: np.ndarray, toxic: np.ndarray, columns: list[str]) -> DataFrame:
    """``columns`` of every row, with its features as doubles, stored."""
    names = [*FEATURES, *TOXIC_FEATURES]
    schema = T.StructType([*(docs.schema[c] for c in columns), *(T.StructField(f, T.DoubleType()) for f in names)])
    model = docs.sparkSession.sparkContext.broadcast((ratios, toxic))

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            texts = [batch["text"][part] for part in flat.groups(batch["text"], GROUP_BYTES)]
            blocks = [np.hstack([features(t, model.value[0]), toxic_features(t, model.value[1])]) for t in texts]
            values = np.concatenate(blocks) if blocks else np.zeros((0, len(names)))
            yield {c: batch[c] for c in columns} | {f: values[:, i].tolist() for i, f in enumerate(names)}

    out = stored(arrow_rows(docs, schema, rows, flat=["text"]), "quality-scores")
    model.destroy()
    return out


def _design(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / scale, -8, 8)
    return np.hstack([z, z**2, np.ones((len(z), 1))])


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, scales and weights (features, their squares, constant) of a ridge logistic fit."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = _design(x, mean, scale)
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 0.5 * np.eye(len(w)), a.T @ (p - y) + 0.5 * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def _log_odds(mean: np.ndarray, scale: np.ndarray, w: np.ndarray, names: tuple[str, ...] = FEATURES) -> Column:
    n = len(names)
    total = F.lit(float(w[-1]))
    for i, f in enumerate(names):
        z = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (F.col(f) - float(mean[i])) / float(scale[i])))
        total = total + z * float(w[i]) + z * z * float(w[n + i])
    return total


def fit_toxic(seen: pd.DataFrame) -> Column | None:
    """Log-odds against toxic, from labelled documents with their features; None if a kind is missing.

    Every third is scored by a fit on the others. The cut is where the share of toxic documents
    found, less ``LOST_WEIGHT`` times the share of others lost, is highest over all three.
    """
    names = (*TOXIC_FEATURES, "n_log")
    seen = seen[seen["toxic"].notna()]
    x, y, fold = seen[list(names)].to_numpy(dtype=float), seen["toxic"].to_numpy(dtype=float), (seen["side"].to_numpy() // 2) % 3
    if len(np.unique(y)) < 2:
        return None
    cut = 0.0
    if all(len(np.unique(y[fold != f])) == 2 for f in range(3)):
        held = np.zeros(len(y))
        for f in range(3):
            mean, scale, w = fit_logistic(x[fold != f], y[fold != f])
            held[fold == f] = _design(x[fold == f], mean, scale) @ w
        cuts = np.sort(held)
        found, lost = (1 - np.searchsorted(np.sort(held[y == k]), cuts) / (y == k).sum() for k in (1, 0))
        cut = float(cuts[np.argmax(found - LOST_WEIGHT * lost)])
    return F.lit(cut) - _log_odds(*fit_logistic(x, y), names)


def top_k_threshold(scores: DataFrame, column: str, k: int) -> float | None:
    """The k-th highest value of ``column``; found by narrowing a histogram, never by a global sort.

    Each round counts at most 4,096 bins; values in the last bin differ by less than rounding.
    """
    lo, hi, n = scores.agg(F.min(column), F.max(column), F.count(column)).first()
    if k <= 0 or n == 0:
        return None
    if k >= n:
        return lo
    bins = 4096
    while True:
        width = (hi - lo) / bins
        inside = scores.where(F.col(column).between(lo, hi))
        if width <= 0 or lo + width == lo:
            return lo
        at = F.least(F.floor((F.col(column) - lo) / width), F.lit(bins - 1)).cast("int")
        counts = {r["bin"]: (r["n"], r["low"], r["high"]) for r in inside.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()}
        for b in sorted(counts, reverse=True):
            size, low, high = counts[b]
            if k <= size:
                break
            k -= size
        if low == high or (low, high) == (lo, hi):
            return low
        lo, hi = low, high


def quality_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", max_labels: int = LABELS) -> DataFrame:
    """``(key, text_key, log_odds)`` for every row of ``docs``; ``text_key`` is a digest of the text.

    ``labels`` has the key, quality (1 good) and toxic (1 bad); a document is a good example
    when its quality is 1 and it isn't toxic, a toxic one a bad example also without a quality;
    other null labels are ignored. Half the labelled documents make the target models, the other
    half the fits. With no example of one kind every document gets log-odds of 0 or, if all
    examples are bad, below. Log-odds against toxic count where they are lower.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_key"))
    # The sample for the fit, at most max_labels rows: the documents of least key hash.
    sample = (
        labels.where(F.col(key).isNotNull() & F.coalesce("quality", "toxic").isNotNull())
        .groupBy(F.col(key).cast("long").alias("key"))
        .agg(
            F.min(F.when(F.col("toxic") == 1, 0).otherwise((F.col("quality") == 1).cast("int"))).alias("good"),
            F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
        )
        .select("key", "good", "toxic", F.xxhash64("key", F.lit("label")).alias("side"))
        .orderBy("side", "key")
        .limit(max_labels)
        .toPandas()
    )
    train = sample[sample["side"] % 2 == 0]
    targets, toxics = (np.sort(train[train[n] == 1]["key"].to_numpy(dtype=np.int64)) for n in ("good", "toxic"))
    raw, target = _counts(source.select("key", "text"), targets, toxics)
    ratios = log_ratios(raw[:SIZE], target[:SIZE]), _log_ratio(raw[SIZE:], target[SIZE:]).astype(np.float32)
    scored = _scored(source, *ratios, ["key", "text_key"])

    rest = sample[sample["side"] % 2 != 0]
    # A label of -1 is none.
    labelled = spark.createDataFrame(rest[["key", "side", "good", "toxic"]].fillna(-1).astype("int64"), "key long, side long, good long, toxic long")
    found = scored.join(labelled, "key").dropDuplicates(["key"]).toPandas().replace({"good": -1, "toxic": -1}, np.nan)
    seen = found[found["good"].notna()]
    odds = F.lit(0.0)
    if len(seen) and seen["good"].nunique() == 2:
        odds = _log_odds(*fit_logistic(seen[list(FEATURES)].to_numpy(dtype=float), seen["good"].to_numpy(dtype=float)))
    elif len(seen):
        odds = F.lit(5.0 if seen["good"].iloc[0] == 1 else -5.0)
    if (against := fit_toxic(found)) is not None:
        odds = F.least(odds, against)
    return scored.select("key", "text_key", odds.alias("log_odds"))


def gumbel_top_k(scores: DataFrame, seed: int = 7, temperature: float = TEMPERATURE) -> DataFrame:
    """``scores`` with ``gumbel`` (log-odds plus keyed noise) and ``kept``.

    The noise of a row depends on its key, its text and the seed, so a rerun gives the same
    sample and repeated rows share their fate. Ties at the threshold all stay.
    """
    uniform = (F.pmod(F.xxhash64("key", "text_key", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    noisy = stored(scores.withColumn("gumbel", F.col("log_odds") - temperature * F.log(-F.log(uniform))), "quality-gumbel")
    k = noisy.where("log_odds >= 0").count()
    least = top_k_threshold(noisy, "gumbel", k)
    return noisy.withColumn("kept", F.lit(False) if least is None else F.col("gumbel") >= least)


def resample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the resampling keeps, with the same columns.

    Texts without words are scored like all others. Rows with one key and text stay or go
    together; null keys are allowed.
    """
    found = gumbel_top_k(quality_scores(docs, labels, key, text)).where("kept")
    kept = found.select(F.col("key").alias("kept_key"), F.col("text_key").alias("kept_text")).distinct()
    rows = packed(docs, key=F.col(key).cast("long"), text_key=F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    same = F.col("key").eqNullSafe(F.col("kept_key")) & (F.col("text_key") == F.col("kept_text"))
    return rows.join(kept, same, "left_semi").select("row.*")
