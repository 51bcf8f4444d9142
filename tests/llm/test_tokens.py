"""Operators 2, 6 and 8 against the tokenizers library."""

import hashlib
import random
import struct
import zlib
from itertools import pairwise

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cascadia.llm import bpe, packing, token_files
from cascadia.llm.common import shared_folder
from cascadia.llm.tokens import as_ids, library_encoder, library_tokenizer, token_bytes

PATH = public_tokenizers.path("byte_bpe_50k.json")


def reference(text):
    return library_tokenizer(PATH).encode(text or "", add_special_tokens=False).ids


TEXT = st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sStaeinr.,!12 \x1c\x85​<|>"), st.characters(exclude_categories=["Cs"])), max_size=80)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_both_encoders_equal_the_library(text):
    expected = reference(text)
    assert as_ids(next(library_encoder(PATH).encode([text]))).tolist() == expected
    codec, encoder = bpe.codec(PATH)
    packed = next(encoder.encode([text]))
    assert as_ids(packed).tolist() == expected
    assert codec.decode(packed) == library_tokenizer(PATH).decode(expected, skip_special_tokens=False)


def test_special_tokens_and_full_cache():
    _, encoder = bpe.codec(PATH)
    texts = ["a<|endoftext|> b c", "<|endoftext|>", "x  <|endoftext|>y", "", " ", " a", "a "]
    small = bpe.ChunkEncoder(encoder.encode_many, encoder.special, limit=1)
    for _ in range(3):
        assert [as_ids(x).tolist() for x in small.encode(texts)] == [reference(t) for t in texts]


def test_failing_words_are_merged_exactly():
    codec = bpe.SpeculativeBpe(PATH)
    rng = random.Random(4)
    words = ["".join(rng.choices("etaoinshr", k=rng.randint(1, 14))).encode() for _ in range(3000)]
    got = codec.encode_words(words)
    assert 0 < codec.failed < len(words)
    assert got == [reference(w.decode()) for w in words]


def test_round_trip_of_odd_rows(spark, make_docs, odd_rows):
    docs = make_docs(*odd_rows)
    rows = bpe.bpe_round_trip(docs, PATH).collect()
    expected = []
    for key, text in odd_rows:
        ids = reference(text)
        expected.append((key, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)
    back = bpe.bpe_decode(bpe.bpe_encode(docs, PATH), PATH).collect()
    assert sorted(((r.doc_id, r.text) for r in back), key=str) == sorted(((k, t or "") for k, t in odd_rows), key=str)
    assert bpe.bpe_round_trip(docs.limit(0), PATH).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=700), st.data())
def test_elias_fano(values, data):
    values.sort()
    code = token_files.EliasFano.of(np.array(values, dtype=np.uint64))
    assert code.select(0, len(values)).tolist() == values
    if values:
        i = data.draw(st.integers(0, len(values) - 1))
        j = data.draw(st.integers(i, len(values)))
        assert code.select(i, j).tolist() == values[i:j]
        assert int(code.select(i)[0]) == values[i]


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(0, 1000, 100_000))
    size = sum(map(len, token_files.EliasFano.of(values).parts()))
    assert size * 8 / len(values) < 2 + np.log2(values[-1] / len(values)) + 0.5


def by_key(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


def test_token_files(spark, make_docs, odd_rows):
    folder = shared_folder(spark, "test-files")
    manifest = token_files.write_token_files(make_docs(*odd_rows), folder, PATH, end_id=2)
    assert manifest.agg({"n_docs": "sum"}).first()[0] == len(odd_rows)
    rows = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    start = 0
    for row, (key, text) in zip(rows, by_key(odd_rows), strict=True):
        ids = [*reference(text), 2]
        assert (row.doc_id, row.start, row.n_tokens) == (key, start, len(ids))
        assert as_ids(row.ids).tolist() == ids
        start += len(ids)
    # Single documents through select alone.
    for part in manifest.collect():
        file = token_files.TokenFile(part.file)
        for i in range(file.n_docs):
            row = next(r for r in rows if r.start == part.base + file.offset(i))
            assert file.document(i).tolist() == as_ids(row.ids).tolist() and file.key(i) == row.doc_id


def test_token_files_of_no_documents(spark, make_docs):
    folder = shared_folder(spark, "test-empty")
    assert token_files.write_token_files(make_docs(), folder, PATH).count() == 0
    assert token_files.read_token_files(spark, folder).count() == 0


def best_cost(places, penalty, window):
    """Least cost by trying every earlier cut."""
    best = [0] + [None] * (len(places) - 1)
    for j in range(1, len(places)):
        options = []
        for i in range(j):
            size = places[j] - places[i]
            if size <= window:
                padding = 0 if size & (size - 1) == 0 else window - size
                options.append(best[i] + padding + penalty[j] + packing.WINDOW_COST)
        best[j] = min(options)
    return best[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.sampled_from([0, 4, 64])), min_size=1, max_size=60))
def test_cuts_are_the_best(steps):
    window = 64
    places = np.concatenate([[0], np.cumsum([s for s, _ in steps])])
    penalty = np.array([0, *(p for _, p in steps)])
    cuts = packing.cut_windows(places, penalty, window)
    assert cuts[-1] == places[-1] and set(cuts) <= set(places.tolist())
    cost_at = dict(zip(places.tolist(), penalty.tolist()))
    cost = 0
    for a, b in pairwise([0, *cuts.tolist()]):
        assert 0 < b - a <= window
        cost += (0 if (b - a) & (b - a - 1) == 0 else window - (b - a)) + cost_at[b] + packing.WINDOW_COST
    assert cost == best_cost(places.tolist(), penalty.tolist(), window)


@pytest.mark.parametrize("block", [1, 1000, 1 << 20])
def test_packing(spark, make_docs, odd_rows, block):
    rows = packing.pack_documents(make_docs(*odd_rows), PATH, 1, window=256, block_ids=block).collect()
    sequences = {}
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(r.ids) and r.length * 4 == len(r.ids)
        sequences.setdefault(r.sequence_id, []).append(r)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
    # In the order of sequences and offsets all ids come in the order of the documents.
    ordered = sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    flat = [i for r in ordered for i in as_ids(r.ids).tolist()]
    assert flat == [i for _, text in by_key(odd_rows) for i in [*reference(text), 1]]
    assert {r.doc_tokens for r in rows} == {len(reference(t)) + 1 for _, t in odd_rows}
    assert packing.pack_documents(make_docs(), PATH, 1).count() == 0


def test_packing_wastes_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sizes = packing.pack_documents(docs, PATH, 1).groupBy("sequence_id").agg({"length": "sum"}).toPandas().iloc[:, 1]
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes.astype(int).tolist())
    assert padding < 0.04 * sizes.sum()


def test_every_token_is_its_own_encoding():
    codec = bpe.SpeculativeBpe(PATH)
    table = token_bytes(PATH)
    assert all(codec.merge(table[i]) == [i] for i in range(0, 50256, 37))


@pytest.mark.parametrize("window", [2, 7, 32, 64, 100])
def test_small_windows(window):
    """Places of a long sentence are never further apart than the window."""
    ids = np.full(1000, 5, dtype=np.uint32)
    ends = np.zeros(100, dtype=bool)
    places, penalty = packing._places(ids, ends, window)
    cuts = packing.cut_windows(np.append(0, places), np.append(0, penalty), window)
    assert cuts[-1] == 1000 and np.diff(np.append(0, cuts)).max() <= window
    with pytest.raises(ValueError):
        packing.cut_windows(np.array([0, 64, 128]), np.zeros(3), 32)
