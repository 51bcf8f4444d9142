"""Operator 7: secrets, by patterns and by token efficiency.

A tokenizer trained on ordinary text needs few tokens for words and many for random strings.
Strings of the alphabets of keys that get fewer than ``MAX_CHARS_PER_TOKEN`` characters from a
token are taken for secrets, unless they are digests of a known length or identifiers. Words
joined to a secret by / - or _ would hide it in the average, so the parts between these signs
are judged, too, and the stretch of them that the tokenizer covers worst.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cascadia.llm.common import arrow_rows

# The base patterns, what a match must hold, and the order of the kinds.
BASE = {
    "assign": (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 32),
}
KINDS = ("assign", "access", "hex", "random")

#: Strings that may be keys: letters, digits and the signs of Base64 and its URL form.
MIN_CHARS = 16
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_-]{{{MIN_CHARS},}}={{0,2}}")
#: Letters of one case are judged from this length on: shorter ones are mostly words.
LETTER_CHARS = 20
PARTS = re.compile(r"[^/_-]+")
#: Characters a token covers: prose about 4, unknown words above 2, random strings about 1.5.
MAX_CHARS_PER_TOKEN = 1.9
#: Lengths of hexadecimal digests in common use (MD5 to SHA-512).
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")
UUID = re.compile(r"(?i:[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})")
#: Identifiers: words and numbers joined by signs, each part letters and then digits or digits alone.
IDENTIFIER = re.compile(r"(?:[A-Z]?[a-z]*|[A-Z]+|)[0-9]*(?:[-_/+](?:[A-Z]?[a-z]*|[A-Z]+)[0-9]*|(?<=[a-z])[A-Z][a-z]+[0-9]*)*=*")
#: Letters of one case that are no word when the tokenizer covers them badly; repeats of few letters stay words.
LETTERS = re.compile(rf"[a-z]{{{LETTER_CHARS},}}|[A-Z]{{{LETTER_CHARS},}}")
MIN_LETTERS = 8
UUID_INSIDE = re.compile(rf"(?<![A-Za-z0-9]){UUID.pattern}(?![A-Za-z0-9])")

_HEX_RUN = re.compile(r"[0-9a-f]{32,}")


@functools.lru_cache(maxsize=4)
def rank_encoder(path: str):
    """tiktoken encoding of a rank file, one per worker process."""
    import base64

    import tiktoken

    from cascadia.llm.bpe import WORDS

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the base patterns as (start, end, kind)."""
    out = []
    for kind, (pattern, group, least) in BASE.items():
        # A run of 32 or more hexadecimal digits is found at once by the stricter pattern.
        found = _HEX_RUN.finditer(text) if kind == "hex" else pattern.finditer(text)
        out.extend((m.start(), m.end(), kind) for m in found if m.end(group) - m.start(group) >= least)
    return out


def is_random(value: str, encoder, limit: float = MAX_CHARS_PER_TOKEN) -> bool:
    """Whether the tokenizer covers ``value`` badly and it is no digest or identifier."""
    if HEX.fullmatch(value) and len(value) in DIGEST_LENGTHS:
        return False
    if UUID.fullmatch(value):
        return False

    def badly(part: str) -> bool:
        return len(part) < limit * len(encoder.encode_ordinary(part))

    if IDENTIFIER.fullmatch(value) and not any(len(set(w)) >= MIN_LETTERS and badly(w) for w in LETTERS.findall(value)):
        return False
    return badly(value)


def _outside(start: int, stop: int, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The pieces of a span that lie outside the sorted spans ``taken``."""
    for a, b in taken:
        if a < stop and start < b:
            if start < a:
                yield start, a
            start = max(start, b)
    if start < stop:
        yield start, stop


def _stretches(text: str, start: int, stop: int, encoder, limit: float) -> Iterator[tuple[int, int]]:
    """The random stretches of whole parts in a run: the one covered worst, then those beside it."""
    parts = []
    for m in PARTS.finditer(text, start, stop):
        digest = HEX.fullmatch(m.group()) and len(m.group()) in DIGEST_LENGTHS
        tokens = 0 if digest else len(encoder.encode_ordinary(m.group()))
        parts.append((m.start(), m.end(), float("-inf") if digest else limit * tokens - len(m.group())))
    ranges = [(0, len(parts))]
    while ranges:
        lo, hi = ranges.pop()
        best, first, total = (0.0, lo, lo), lo, 0.0
        for i in range(lo, hi):
            if total <= 0:
                first, total = i, 0.0
            total += parts[i][2]
            if total > best[0]:
                best = (total, first, i + 1)
        _, i, j = best
        if i == j:
            continue
        a, b = parts[i][0], parts[j - 1][1]
        if b - a >= MIN_CHARS and is_random(text[a:b], encoder, limit):
            yield a, b
        ranges += [(lo, i), (j, hi)]


def _random_spans(text: str, start: int, stop: int, encoder, limit: float) -> Iterator[tuple[int, int]]:
    if stop - start < MIN_CHARS:
        return
    if is_random(text[start:stop], encoder, limit) and not UUID_INSIDE.search(text, start, stop):
        yield start, stop
        return
    # An identifier of the UUID form is no part of a secret.
    for a, b in _outside(start, stop, [m.span() for m in UUID_INSIDE.finditer(text, start, stop)]):
        if b - a >= MIN_CHARS:
            yield from _stretches(text, a, b, encoder, limit)


def find_spans(text: str, encoder, limit: float = MAX_CHARS_PER_TOKEN) -> list[tuple[int, int, str]]:
    """All spans of a text by start and kind; random strings are looked for outside the base spans."""
    spans = base_spans(text)
    taken = sorted((a, b) for a, b, _ in spans)
    for m in CANDIDATE.finditer(text):
        for start, stop in _outside(m.start(), m.end(), taken):
            spans.extend((a, b, "random") for a, b in _random_spans(text, start, stop, encoder, limit))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]
)


def scan_secrets(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """``(key, spans)``: for every row the secrets of its whole text, in code points.

    Null and empty texts have no spans. Rows stay as they are, repeated ones too.
    """
    schema = T.StructType([docs.schema[key], T.StructField("spans", T.ArrayType(SPAN))])

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        encoder = rank_encoder(path)
        for batch in batches:
            spans = [[{"kind": k, "start": a, "stop": b} for a, b, k in find_spans(t or "", encoder, limit)] for t in batch[text]]
            yield {key: batch[key], "spans": spans}

    return arrow_rows(docs.select(key, text), schema, rows)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def redact(text: str, spans: list[tuple[int, int, str]], mark: str) -> str:
    if not spans:
        return text
    out, at = [], 0
    for a, b, _ in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, path: str, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with every secret replaced by ``mark``; null texts stay null.

    Spans that overlap are replaced as one. A column ``n_chars`` is set to the new length.
    """

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        encoder = rank_encoder(path)
        for batch in batches:
            old = batch[text]
            batch[text] = [t and redact(t, find_spans(t, encoder), mark) for t in old]
            if "n_chars" in batch:
                batch["n_chars"] = [n if t is s else len(t) for n, t, s in zip(batch["n_chars"], batch[text], old)]
            yield batch

    return arrow_rows(docs, docs.schema, rows)


def base_digest(spans: list[tuple[int, int, str]]) -> str:
    """Digest of the base spans alone, as a plain function for tests."""
    line = ",".join(f"{k}:{a}:{b}" for a, b, k in spans if k != "random")
    return hashlib.sha256(line.encode()).hexdigest()
