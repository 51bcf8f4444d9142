"""Words of many texts at once, as places in one array of bytes, and their 64-bit hashes.

Hashes come from the bytes alone, eight at a time, so workers keep no store of words. Among n
distinct words two share a hash with a probability of about n**2 / 2**65: 3e-4 for 10**8 words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes after the last text, so that eight bytes can be read at any place.
SPARE = 8
SPACE = 0x20
#: A-Z to lower case, white space to one kind.
FOLD = np.array([SPACE if b == SPACE or 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
#: Spans longer than this are hashed one by one.
LONG_SPAN = 256

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: The low bytes of a number, by how many.
MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)

Texts = list | pa.Array


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, without spare ones, and where each begins and the last ends.

    Null texts are empty. An Arrow column of strings is read in place.
    """
    if not isinstance(texts, pa.Array):
        texts = pa.array([t.encode() if isinstance(t, str) else t for t in texts], pa.large_binary())
    if not len(texts):
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, "<i8" if wide else "<i4")[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def folded(data: np.ndarray) -> np.ndarray:
    """``data`` in lower case, with one kind of white space and spare bytes at its end."""
    out = np.full(len(data) + SPARE, SPACE, dtype=np.uint8)
    np.take(FOLD, data, out=out[: len(data)], mode="clip")
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and size of every word in folded ``data``, and how many words each text has."""
    n = int(offsets[-1])
    letter = data[: n + 1] != SPACE
    letter[n] = False
    before = np.empty(n + 1, dtype=bool)
    before[0] = False
    before[1:] = letter[:-1]
    # A word ends with its text.
    before[offsets] = False
    start = np.flatnonzero(letter & ~before)
    ends = np.zeros(n + 1, dtype=bool)
    ends[1:] = letter[:-1] & (~letter[1:])
    last = offsets[1:][np.diff(offsets) > 0]
    ends[last] = letter[last - 1]
    counts = np.diff(np.searchsorted(start, offsets))
    return start, np.flatnonzero(ends) - start, counts


def windows(data: np.ndarray) -> np.ndarray:
    """The eight bytes at every place as a number, little-endian."""
    return np.ndarray((max(0, len(data) - SPARE + 1),), dtype="<u8", buffer=data, strides=(1,))


def span_hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of ``data``."""
    view = windows(data)
    out = size.astype(np.uint64) * _A
    todo = np.flatnonzero((size > 0) & (size <= LONG_SPAN))
    place, left = start[todo], size[todo]
    while len(todo):
        out[todo] = mixed(out[todo] + (view[place] & MASKS[np.minimum(left, 8)]))
        more = left > 8
        todo, place, left = todo[more], place[more] + 8, left[more] - 8
    if len(long := np.flatnonzero(size > LONG_SPAN)):
        import xxhash

        for i in long.tolist():
            out[i] = xxhash.xxh3_64_intdigest(data[start[i] : start[i] + size[i]].tobytes())
    return out


def text_words(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one after another, and how many each text has."""
    raw, offsets = text_bytes(texts)
    data = folded(raw)
    start, size, counts = words(data, offsets)
    return span_hashes(data, start, size), counts


def lengths(texts: Texts) -> np.ndarray:
    """Bytes of each text."""
    return np.diff(text_bytes(texts)[1])


def groups(texts: Texts, most: int) -> list[slice]:
    """Slices of texts, each of about ``most`` bytes, one text at least."""
    ends = np.cumsum(lengths(texts)) // most
    cuts = np.flatnonzero(np.diff(ends, prepend=0)) + 1
    cuts = [0, *[c for c in cuts.tolist() if c < len(ends)], len(ends)]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]


def binary(rows: np.ndarray) -> pa.Array:
    """Rows of bytes of one width as a binary column."""
    rows = np.ascontiguousarray(rows)
    places = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(places), pa.py_buffer(rows)])
