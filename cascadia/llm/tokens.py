"""Exact token ids of whole texts, with the work on repeated text chunks done once.

The byte-level pattern never joins a space with the text before it, so a text falls apart at
its single spaces into chunks (one leading space and what follows up to the next space) whose
ids don't depend on their neighbours. Each worker keeps the ids of the chunks it has met, in
flat arrays: a chunk is found by a 64-bit hash of its bytes, and its length and first eight
bytes are compared. A text in which white space meets a space, or that holds a special token, is
encoded as one, and so is a text whose chunk fails that comparison.
"""

from __future__ import annotations

import functools
import json
import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

from cascadia.llm import flat
from cascadia.llm.common import only_store

#: Chunks kept by a worker (about 40 bytes each) and the longest one that is kept, in bytes.
CACHE_CHUNKS = 2_000_000
CACHE_BYTES = 64
#: Unseen chunks handed to the library as one text.
CHUNKS_AT_ONCE = 20_000
#: Bytes of text taken at once.
GROUP_BYTES = 4 << 20

#: Name of the store that a worker keeps of chunks.
CHUNKS = "chunks"

EncodeMany = Callable[[list[str]], list[list[int]]]
EncodeChunks = Callable[[list[str]], list[bytes]]

#: Number of ids of a chunk whose ids depend on its neighbours.
_IRREGULAR = -1


class _Table:
    """Chunks by hash: what tells them apart, where their ids lie and how many they are."""

    def __init__(self, keys=(), check=(), place=(), count=()):
        self.keys, self.check = np.array(keys, np.uint64), np.array(check, np.uint64)
        self.place, self.count = np.array(place, np.int64), np.array(count, np.int32)
        self.touched = np.zeros(len(self.keys), dtype=bool)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of ascending ``keys``, and which of them are there."""
        if not len(self.keys):
            return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def merged(self, other: _Table) -> _Table:
        order = np.argsort(np.concatenate([self.keys, other.keys]), kind="stable")
        out = _Table()
        for name in ("keys", "check", "place", "count", "touched"):
            setattr(out, name, np.concatenate([getattr(self, name), getattr(other, name)])[order])
        return out

    def kept(self, some: np.ndarray) -> _Table:
        return _Table(self.keys[some], self.check[some], self.place[some], self.count[some])


class _Store:
    """Ids of chunks: a large table, a small one of the latest chunks, and all ids in one array."""

    def __init__(self, limit: int):
        self.limit = limit
        self.tables = [_Table(), _Table()]
        self.ids, self.used = np.empty(1 << 12, dtype="<u4"), 0

    def find(self, keys: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per key the place and number of ids, whether it is known, and whether another chunk has its hash."""
        place, count = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int32)
        known, clash = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
        for table in self.tables:
            at, there = table.find(keys)
            at = at[there]
            place[there], count[there] = table.place[at], table.count[at]
            clash[there] |= table.check[at] != check[there]
            table.touched[at] = True
            known |= there
        return place, count, known, clash

    def append(self, packed: bytes) -> int:
        """Put ids behind the others; returns their place."""
        new = np.frombuffer(packed, dtype="<u4")
        if self.used + len(new) > len(self.ids):
            grown = np.empty(max(2 * len(self.ids), self.used + len(new)), dtype="<u4")
            grown[: self.used] = self.ids[: self.used]
            self.ids = grown
        first = self.used
        self.ids[first : first + len(new)] = new
        self.used += len(new)
        return first

    def add(self, table: _Table) -> None:
        large, small = self.tables
        small = small.merged(table)
        if 4 * len(small.keys) > len(large.keys):
            large, small = large.merged(small), _Table()
        self.tables = [large, small]
        if len(large.keys) + len(small.keys) > self.limit:
            self._drop()

    def _drop(self) -> None:
        """Keep chunks met again since the last time, half the limit at most."""
        whole = self.tables[0].merged(self.tables[1])
        kept = whole.kept(np.flatnonzero(whole.touched)[: self.limit // 2])
        count = np.maximum(kept.count, 0)
        end = np.cumsum(count, dtype=np.int64)
        self.ids = self.ids[spread(kept.place, count)]
        self.used = len(self.ids)
        kept.place = end - count
        self.tables = [kept, _Table()]


def spread(place: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Positions ``place, place + 1, ...`` of each run, ``count`` of them, one run after another."""
    end = np.cumsum(count, dtype=np.int64)
    total = int(end[-1]) if len(end) else 0
    return np.repeat(place - (end - count), count) + np.arange(total)


class ChunkEncoder:
    """Encodes texts to little-endian 32-bit ids; ``encode_many`` gives exact ids of whole strings."""

    def __init__(self, encode_many: EncodeMany, special: Iterable[str | bytes], limit: int = CACHE_CHUNKS, chunks: EncodeChunks | None = None):
        self.encode_many = encode_many
        self.encode_chunks = chunks or self._whole
        self.special = tuple(s if isinstance(s, bytes) else s.encode() for s in special)
        self.limit = limit
        self.forget()

    def forget(self) -> None:
        self.store = _Store(self.limit)

    def encode(self, texts: flat.Texts | Iterable[str | None]) -> Iterator[bytes]:
        """Ids of each text; a null text counts as empty."""
        only_store(CHUNKS, self.forget)
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        for part in flat.groups(texts, GROUP_BYTES):
            yield from self._group(texts[part])

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in self.encode_many(texts)]

    def _group(self, texts: pa.Array) -> list[bytes]:
        raw, offsets = flat.text_bytes(texts)
        data = np.append(raw, np.zeros(flat.SPARE, dtype=np.uint8))
        # A text's head up to its first space, then a chunk from each space on.
        spaces = np.flatnonzero(raw == flat.SPACE)
        before = np.searchsorted(spaces, offsets)
        heads = np.arange(len(texts)) + before[:-1]
        start = np.empty(len(texts) + len(spaces), dtype=np.int64)
        start[heads] = offsets[:-1]
        start[np.arange(len(spaces)) + np.repeat(np.arange(1, len(texts) + 1), np.diff(before))] = spaces
        size = np.diff(start, append=len(raw))
        hashes = flat.span_hashes(data, start, size)
        check = flat.windows(data)[start] & flat.MASKS[np.minimum(size, 8)]
        check ^= size.astype(np.uint64) << np.uint64(56)
        keys, first, chunk = np.unique(hashes, return_index=True, return_inverse=True)
        place, count, known, clash = self.store.find(keys, check[first])
        self._learn(data, start, size, keys, check[first], first, np.flatnonzero(~known), place, count)
        counts = np.where(clash[chunk] | (check != check[first][chunk]), _IRREGULAR, count[chunk])

        odd = np.zeros(len(texts), dtype=bool)
        odd[np.searchsorted(heads, np.flatnonzero(counts < 0), side="right") - 1] = True
        for mark in self.special:
            odd[self._holding(raw, offsets, mark)] = True
        counts = np.maximum(counts, 0)
        ids = self.store.ids[spread(place[chunk], counts)].tobytes()
        ends = np.concatenate([[0], np.cumsum(counts)])[np.append(heads, len(start))]
        cuts = (4 * ends).tolist()
        out = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
        if len(some := np.flatnonzero(odd)):
            for i, whole in zip(some.tolist(), self._whole([texts[i].as_py() for i in some.tolist()])):
                out[i] = whole
        # Only now, as dropping chunks moves the ids.
        if self.fresh is not None:
            self.store.add(self.fresh)
        return out

    @staticmethod
    def _holding(raw: np.ndarray, offsets: np.ndarray, mark: bytes) -> list[int]:
        """Texts in which ``mark`` begins."""
        data, found, at = raw.tobytes(), [], -1
        while (at := data.find(mark, at + 1)) >= 0:
            found.append(int(np.searchsorted(offsets, at, side="right")) - 1)
        return found

    def _learn(self, data, start, size, keys, check, first, missing, place, count) -> None:
        """Encode the chunks of ``missing`` keys; fills in their ``place`` and ``count``."""
        self.fresh = None
        if not len(missing):
            return
        at = first[missing]
        # Those that are not kept come last, to be overwritten by the next ones.
        order = np.argsort(size[at] > CACHE_BYTES, kind="stable")
        missing, at = missing[order], at[order]
        words = [data[a : a + n].tobytes().decode() for a, n in zip(start[at].tolist(), size[at].tolist())]
        spaced = [i for i, w in enumerate(words) if w[:1] == " " and len(w) > 1 and not w[1].isspace() and not w[-1].isspace()]
        heads = [i for i, w in enumerate(words) if w[:1] != " " and not w[-1:].isspace()]
        ids: list[bytes | None] = [None] * len(words)
        for some, encode in ((spaced, self.encode_chunks), (heads, self._whole)):
            for i, x in zip(some, encode([words[i] for i in some])):
                ids[i] = x
        number = np.array([_IRREGULAR if x is None else len(x) // 4 for x in ids], dtype=np.int32)
        here = self.store.append(b"".join(x for x in ids if x))
        room = np.maximum(number, 0)
        count[missing] = number
        place[missing] = here + np.cumsum(room, dtype=np.int64) - room
        some = np.flatnonzero(size[at] <= CACHE_BYTES)
        self.store.used = here + int(room[some].sum())
        some = missing[some]
        some = some[np.argsort(keys[some])]
        self.fresh = _Table(keys[some], check[some], place[some], count[some])


@functools.lru_cache(maxsize=4)
def library_tokenizer(path: str):
    """The tokenizers library's own encoder of a vocabulary file, without truncation or padding."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@functools.lru_cache(maxsize=4)
def library_encoder(path: str) -> ChunkEncoder:
    """Chunk encoder whose ids come from the tokenizers library (one per worker process)."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    tokenizer = library_tokenizer(path)

    def many(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

    sizes = np.array(list(map(len, token_bytes(path))), dtype=np.int64)

    def chunks(parts: list[str]) -> list[bytes]:
        """Many chunks as one text, whose ids are dealt out again by the bytes they stand for."""
        out: list[bytes] = []
        for a in range(0, len(parts), CHUNKS_AT_ONCE):
            some = parts[a : a + CHUNKS_AT_ONCE]
            (encoded,) = tokenizer.encode_batch_fast(["".join(some)], add_special_tokens=False)
            ids = np.array(encoded.ids, dtype="<u4")
            ends = np.cumsum([len(p.encode()) for p in some])
            cuts = [0, *(np.searchsorted(np.cumsum(sizes[ids]), ends) + 1).tolist()]
            raw = ids.tobytes()
            out.extend(raw[4 * i : 4 * j] for i, j in zip(cuts, cuts[1:]))
        return out

    return ChunkEncoder(many, special_tokens(path), chunks=chunks)


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def special_tokens(path: str) -> list[str]:
    return [t["content"] for t in vocabulary(path)["added_tokens"]]


@functools.lru_cache(maxsize=1)
def byte_alphabet() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary.

    Printable bytes stand for themselves, the others for the code points from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@functools.lru_cache(maxsize=4)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of every id; a special token stands for its text."""
    data = vocabulary(path)
    alphabet = byte_alphabet()
    vocab = data["model"]["vocab"]
    size = max([*vocab.values(), *(t["id"] for t in data["added_tokens"])]) + 1
    table = [b""] * size
    for token, i in vocab.items():
        table[i] = bytes(alphabet[c] for c in token)
    for t in data["added_tokens"]:
        table[t["id"]] = t["content"].encode()
    return table


def as_ids(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, dtype="<u4")
