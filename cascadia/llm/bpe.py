"""Operator 8: byte-level BPE encoding by speculation and verification, and decoding.

A greedy longest match proposes the tokens of a word. Encoding merges pairs by rank, so a
token list is the encoding of its word exactly if every adjacent pair is the encoding of its
own bytes. That test runs over all adjacent pairs of all words of a batch at once; only words
with a failing pair are merged exactly, pair by pair.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cascadia.llm.common import arrow_rows
from cascadia.llm.tokens import CHUNKS, ChunkEncoder, as_ids, byte_alphabet, token_bytes, vocabulary

#: Fixed value: the pattern that splits text into words before the merges.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class SpeculativeBpe:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, path: str):
        data = vocabulary(path)
        self.bytes_of = token_bytes(path)
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.special = special
        vocab = data["model"]["vocab"]
        size = len(self.bytes_of)
        self.left = np.arange(size, dtype=np.int64)
        self.right = np.arange(size, dtype=np.int64)
        #: Order in which a token comes into being; single bytes come before all merges.
        self.rank = np.full(size, -1, dtype=np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(data["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            i, j, new = vocab[a], vocab[b], vocab[a + b]
            self.merges[i, j] = (rank, new)
            self.left[new], self.right[new], self.rank[new] = i, j, rank
        keys = np.array([i * size + j for i, j in self.merges], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([r for r, _ in self.merges.values()], dtype=np.int64)[order]
        self.size = size
        self.ids = {self.bytes_of[i]: i for t, i in vocab.items()}
        self.longest = max(map(len, self.ids))
        self.pattern = regex.compile(WORDS)
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.failed = self.tried = 0

    # Words

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        ids, at, n = self.ids, 0, len(word)
        whole = ids.get(word)
        if whole is not None:
            return [whole]
        out = []
        while at < n:
            end = min(n, at + self.longest)
            while (token := ids.get(word[at:end])) is None:
                end -= 1
            out.append(token)
            at = end
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of tokens are the encoding of their joined bytes.

        Steps back through the merges that made the two tokens, the latest first. The pair
        fails if, at some moment, the parts that touch merge with each other earlier than the
        step just undone would have happened. Of equal ranks the left one comes first.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        ok = np.ones(len(a), dtype=bool)
        live = np.arange(len(a))
        x, y = a.copy(), b.copy()
        # Ranks count twice as much so that "not later than" differs from "earlier than".
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(live):
            key = x * self.size + y
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            merged = np.where(self.pair_keys[at] == key, 2 * self.pair_ranks[at], np.iinfo(np.int64).max)
            bad = merged < limit
            rx, ry = self.rank[x], self.rank[y]
            done = (rx < 0) & (ry < 0)
            ok[live[bad]] = False
            go = ~bad & ~done
            live, x, y, rx, ry = live[go], x[go], y[go], rx[go], ry[go]
            back_x = rx > ry
            # Undoing the left token: a merge across must come before it. Undoing the right
            # one: a merge across of the same rank lies further left and also wins.
            limit = np.where(back_x, 2 * rx, 2 * ry + 1)
            x = np.where(back_x, self.right[x], x)
            y = np.where(back_x, y, self.left[y])
        return ok

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: the pair of least rank first, the leftmost of equals."""
        import heapq

        out = [self.ids[word[i : i + 1]] for i in range(len(word))]
        n = len(out)
        after = list(range(1, n)) + [-1]
        before = [-1, *range(n - 1)]
        heap = []
        for i in range(n - 1):
            if m := self.merges.get((out[i], out[i + 1])):
                heap.append((m[0], i, out[i], out[i + 1], m[1]))
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if out[i] != a or j < 0 or out[j] != b:
                continue
            out[i], out[j] = new, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
                if m := self.merges.get((new, out[after[j]])):
                    heapq.heappush(heap, (m[0], i, new, out[after[j]], m[1]))
            if before[i] >= 0 and (m := self.merges.get((out[before[i]], new))):
                heapq.heappush(heap, (m[0], before[i], out[before[i]], new, m[1]))
        return [t for t in out if t >= 0]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        tokens = [self.propose(w) for w in words]
        count = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        flat = np.fromiter((t for ts in tokens for t in ts), dtype=np.int64, count=int(count.sum()))
        owner = np.repeat(np.arange(len(tokens)), count)
        inner = np.flatnonzero(owner[1:] == owner[:-1]) if len(flat) else np.empty(0, np.int64)
        pairs, back = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)[back]
        for i in np.unique(owner[inner[~good]]):
            tokens[i] = self.merge(words[i])
            self.failed += 1
        self.tried += len(words)
        return tokens

    # Texts

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        """Exact ids of whole strings; special tokens in them become their id."""
        words: dict[str, int] = {}
        plans: list[list[int]] = []
        for text in texts:
            plan = []
            pieces = self.special_pattern.split(text) if self.special_pattern else [text]
            for piece in pieces:
                if piece in self.special:
                    plan.append(-1 - self.special[piece])
                else:
                    plan.extend(words.setdefault(w, len(words)) for w in self.pattern.findall(piece))
            plans.append(plan)
        ids = self.encode_words([w.encode("utf-8", "surrogatepass") for w in words])
        return [[t for i in plan for t in (ids[i] if i >= 0 else (-1 - i,))] for plan in plans]

    def decode(self, packed: bytes) -> str:
        table = self.bytes_of
        return b"".join(map(table.__getitem__, as_ids(packed).tolist())).decode("utf-8", "replace")


@functools.lru_cache(maxsize=4)
def codec(path: str) -> tuple[SpeculativeBpe, ChunkEncoder]:
    """One codec and chunk store per worker process and vocabulary."""
    bpe = SpeculativeBpe(path)
    return bpe, ChunkEncoder(bpe.encode_many, bpe.special)


def _encoded(path: str, keep: list[str], text: str, finish) -> callable:
    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        bpe, encoder = codec(path)
        for batch in batches:
            ids = list(encoder.encode(batch[text]))
            yield {k: batch[k] for k in keep} | finish(bpe, ids)

    return rows


def bpe_encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, ids binary)``: ids of every whole text as little-endian 32-bit numbers.

    A null text counts as empty and has no ids. Rows stay as they are, repeated ones too;
    other columns are left out.
    """
    schema = T.StructType([docs.schema[key], T.StructField("ids", T.BinaryType())])
    return arrow_rows(docs.select(key, text), schema, _encoded(path, [key], text, lambda bpe, ids: {"ids": ids}), flat=[text], store=CHUNKS)


def bpe_decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(key, text)`` of the ids; bytes that are no UTF-8 become replacement characters."""
    schema = T.StructType([encoded.schema[key], T.StructField("text", T.StringType())])

    def rows(batches: Iterator[dict]) -> Iterator[dict]:
        bpe, _ = codec(path)
        for batch in batches:
            yield {key: batch[key], "text": [bpe.decode(x or b"") for x in batch[ids]]}

    return arrow_rows(encoded.select(key, ids), schema, rows)


def bpe_round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the number of ids and digests of the ids and of the text decoded from them."""
    schema = T.StructType(
        [
            docs.schema[key],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )

    def finish(bpe: SpeculativeBpe, ids: list[bytes]) -> dict:
        return {
            "n_tokens": [len(x) // 4 for x in ids],
            "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids],
        }

    return arrow_rows(docs.select(key, text), schema, _encoded(path, [key], text, finish), flat=[text], store=CHUNKS)
