"""Operators 1, 4 and 5 against brute force."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from cascadia.llm import hnsw, near_documents, near_lines
from cascadia.llm.common import components
from tests.llm.conftest import prose


def grouped(nodes, edges):
    """Least node of each node's component."""
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {n: top(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 6000 + i) for i in range(200)]
    df = spark.createDataFrame([*edges, (None, 3), (7, None)], "a long, b long")
    got = {r.node: r.component for r in components(df, "a", "b").collect()}
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    expected = grouped(nodes, [e for e in edges if e[0] != e[1]])
    assert got == expected
    assert components(df.limit(0), "a", "b").count() == 0


# Operator 5


def shingle_set(text, n):
    words = (text or "").encode().lower().split()
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute_documents(rows, n, percent):
    sets = [(k, shingle_set(t, n)) for k, t in rows if k is not None]
    edges = [
        (a, b)
        for i, (a, x) in enumerate(sets)
        for b, y in sets[:i]
        if x and y and 100 * len(x & y) >= percent * len(x | y)
    ]
    return grouped({k for k, _ in sets}, edges)


def edited(text, rng, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = "edit" + str(rng.randrange(10**6))
    return " ".join(words)


def test_near_documents(spark, make_docs, odd_rows):
    rng = random.Random(1)
    rows = list(odd_rows)
    for group in range(6):
        text = prose(1000 + group, 120)
        rows += [(100 * (group + 1) + i, edited(text, rng, i % 6)) for i in range(25)]
    rows += [(900, "A b"), (901, "a  B"), (902, "a b c"), (903, "a")]
    rng.shuffle(rows)
    docs = make_docs(*rows)
    for n, percent in ((3, 85), (5, 80)):
        expected = brute_documents(rows, n, percent)
        got = near_documents.near_documents(docs, n, percent).collect()
        assert len(got) == len(rows)
        for r in got:
            assert r.component_id == (None if r.doc_id is None else expected[r.doc_id])
        sizes = sorted((str(k), len(shingle_set(t, n))) for k, t in rows)
        assert sorted((str(r.doc_id), r.n_shingles) for r in got) == sizes
    out = near_documents.drop_near_documents(docs)
    assert out.schema == docs.schema
    kept = [r.doc_id for r in out.collect()]
    expected = brute_documents(rows, 5, 80)
    assert sorted(kept, key=str) == sorted([k for k, c in expected.items() if k == c] + [None], key=str)


def test_near_documents_of_nothing(spark, make_docs):
    assert near_documents.near_documents(make_docs()).count() == 0
    assert near_documents.drop_near_documents(make_docs((1, None))).count() == 1


def test_near_documents_on_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r.component_id for r in near_documents.near_documents(docs, 3, 85).collect()}
    assert got == brute_documents(rows, 3, 85)


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, near_documents.MAX_ERRORS))
def test_every_pair_within_the_distance_shares_a_key(seed, errors):
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 16, near_documents.POSITIONS).astype("<u2")
    b = a.copy()
    b[rng.permutation(near_documents.POSITIONS)[:errors]] += np.uint16(1)
    keys = near_documents.chunk_keys(np.stack([a, b]))
    assert set(keys[0]) & set(keys[1])


# Operator 4


def brute_lines(rows):
    """Places of lines with an earlier equal line, and of first lines with one within an edit."""
    first, equal = {}, set()
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        for i, line in enumerate((text or "").split("\n")):
            words = tuple(near_lines.line_words(line))
            if words:
                if words in first:
                    equal.add((key, i))
                else:
                    first[words] = (key, i)
    order = {w: n for n, w in enumerate(first)}
    near = {
        first[b]
        for a in first
        for b in first
        if order[a] < order[b] and min(len(a), len(b)) >= near_lines.MIN_EDIT_WORDS and near_lines.within_one_edit(list(a), list(b))
    }
    return equal, near


def lines_of(found):
    rows = found.collect()
    return {(r.doc, r.line) for r in rows if r.n_edits == 0}, {(r.doc, r.line) for r in rows if r.n_edits == 1}


def line_rows():
    rng = random.Random(8)
    bases = [prose(3000 + i, rng.choice([3, 7, 8, 9, 15, 40])) for i in range(30)]
    rows = []
    for key in range(60):
        lines = []
        for _ in range(rng.randrange(6)):
            words = rng.choice(bases).split(" ")
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                i = rng.randrange(len(words))
                words[i : i + rng.choice([0, 1, 1])] = rng.choice([["changed"], ["more"], []])
            lines.append(rng.choice(["", "  ", "\t"]) + rng.choice([str.upper, str])(" ".join(words)))
        rows.append((key, "\n".join(lines)))
    return rows


def test_near_lines(spark, make_docs):
    rows = [*line_rows(), (70, None), (71, ""), (72, "\n \n"), (None, prose(3000, 40)), (80, "same text"), (80, "same text")]
    docs = make_docs(*rows)
    equal, near = lines_of(near_lines.near_lines(docs))
    unique = list(dict.fromkeys(rows))
    assert (equal, near) == brute_lines(unique)
    assert near and equal
    out = near_lines.drop_near_lines(docs)
    assert out.schema == docs.schema
    lost = equal | near
    expected = []
    for key, text in rows:
        kept = [x for i, x in enumerate((text or "").split("\n")) if (key, i) not in lost]
        if text is None or len(kept) == len(text.split("\n")):
            expected.append((key, text, None if text is None else len(text)))
        elif any(x.encode().split() for x in kept):
            expected.append((key, "\n".join(kept), len("\n".join(kept))))
    assert sorted(((r.doc_id, r.text, r.n_chars) for r in out.collect()), key=str) == sorted(expected, key=str)


def test_near_lines_of_nothing(make_docs):
    assert near_lines.near_lines(make_docs()).count() == 0
    assert near_lines.drop_near_lines(make_docs((1, None), (2, ""))).count() == 2


def test_long_texts_and_hot_lines(spark, make_docs):
    hot = prose(77, 12)
    rows = [(i, hot + "\n" + prose(5000 + i, 30)) for i in range(300)]
    rows.append((999, "\n".join(prose(9000 + i, 25) for i in range(2000))))
    equal, near = lines_of(near_lines.near_lines(make_docs(*rows)))
    assert equal == {(i, 0) for i in range(1, 300)} and not near


def test_earlier_lines_stay_earlier_in_many_files(spark, make_docs):
    """The sorted lines fill files of unequal size: the last ones, of many documents, are larger."""
    lines = [prose(7000 + i, 12) for i in range(400)]
    docs = make_docs((0, "\n".join(lines)), *((i + 1, line + " more") for i, line in enumerate(lines)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = near_lines.near_lines(docs).collect()
        kept = near_lines.drop_near_lines(docs).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {(r.doc, r.line, r.first_doc, r.first_line) for r in found} == {(i + 1, 0, 0, i) for i in range(400)}
    assert [(r.doc_id, r.text) for r in kept] == [(0, "\n".join(lines))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=6), st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=6))
def test_one_edit(a, b):
    near = a == b
    for x, y in ((a, b), (b, a)):
        near |= any(x[:i] + x[i + 1 :] == y for i in range(len(x)))
    near |= len(a) == len(b) and sum(p != q for p, q in zip(a, b)) == 1
    assert near_lines.within_one_edit(a, b) == near


# Operator 1

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("rep", T.StringType()), T.StructField("id", T.StringType())])


def brute_vectors(rows, threshold=0.9):
    def good(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    ids = sorted({i for i, *_ in rows if i is not None})
    usable = {i: np.array(v, dtype=np.float64) for i, v in rows if i is not None and good(v)}
    usable = {i: v / np.abs(v).max() for i, v in usable.items()}
    edges = [
        (a, b)
        for a in usable
        for b in usable
        if a < b and len(usable[a]) == len(usable[b]) and usable[a] @ usable[b] / math.sqrt((usable[a] @ usable[a]) * (usable[b] @ usable[b])) >= threshold
    ]
    degree = {i: sum(i in e for e in edges) for i in ids}
    return degree, grouped(ids, edges)


def vector_rows():
    rng = np.random.default_rng(6)
    rows = []
    for group in range(20):
        centre = rng.normal(size=16)
        rows += [(100 * group + i, (centre + 0.08 * rng.normal(size=16)).astype("float32").tolist()) for i in range(group + 1)]
    rows += [(5000 + i, rng.normal(size=16).astype("float32").tolist()) for i in range(300)]
    rows += [(6000 + i, rows[0][1]) for i in range(40)]
    rows += [(7000, None), (7001, []), (7002, [0.0] * 16), (7003, [1.0, None] * 8), (7004, [math.nan] * 16), (7005, [math.inf] * 16)]
    rows += [(7006, [1.0, 2.0]), (7007, [2.0, 4.0]), (7008, [1e-30] * 16), (7009, [1e30] * 16)]
    return rows


@pytest.mark.parametrize("limits", [(100 * 16 * 4, 150), (hnsw.SHARD_BYTES, 150), (hnsw.SHARD_BYTES, hnsw.LEAST_ROWS)])
def test_near_vectors(spark, limits):
    rows = vector_rows()
    degree, part = brute_vectors(rows)
    # A repeated row and rows without a key change nothing.
    df = spark.createDataFrame([(i, v, "r", "i") for i, v in [*rows, rows[0], (None, rows[0][1])]], VECTORS)
    got = hnsw.near_vectors(df, shard_bytes=limits[0], least_rows=limits[1]).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id) == (0, None)
        else:
            assert (r.n_links, r.component_id) == (degree[r.vec_id], part[r.vec_id])
    assert hnsw.near_vectors(df.limit(0)).count() == 0


def recall(vectors, threshold=0.9):
    """Share of the links between different vectors that a graph over all of them finds."""
    exact = vectors @ vectors.T >= threshold
    np.fill_diagonal(exact, False)
    graph = hnsw.Graph.unpacked(hnsw.Graph.build(vectors).packed(), vectors)
    row, node, near = graph.neighbours(vectors, np.arange(len(vectors)), threshold)
    assert exact[row, node].all() and len(np.unique(row * len(vectors) + node)) == len(row)
    return len(row) / exact.sum()


def test_recall_on_a_large_group_of_near_copies():
    rng = np.random.default_rng(9)
    centre = rng.normal(size=64)
    vectors = hnsw.unit(np.vstack([centre + 0.1 * rng.normal(size=(800, 64)), rng.normal(size=(3000, 64))])).astype(np.float32)
    assert recall(vectors) >= 0.99


def test_recall_with_few_links():
    rng = np.random.default_rng(10)
    vectors = rng.normal(size=(6000, 64))
    vectors[:60] = vectors[60:120] + 0.25 * rng.normal(size=(60, 64))
    assert recall(hnsw.unit(vectors).astype(np.float32)) >= 0.99


def test_beams_widen_until_the_audit_passes(monkeypatch):
    """A graph cut into pieces hides links from narrow beams, not from the audit."""
    rng = np.random.default_rng(11)
    vectors = rng.normal(size=(900, 32))
    vectors[450:] = vectors[:450] + 0.1 * rng.normal(size=(450, 32))
    vectors = hnsw.unit(vectors).astype(np.float32)
    graph = hnsw.Graph.build(vectors)
    links = graph.layers[0]
    links[np.abs(links - np.arange(900)[:, None]) == 450] = -1
    monkeypatch.setattr(hnsw, "FIRST_BEAM", 2)
    row, node, _ = graph.neighbours(vectors, np.arange(900), 0.9)
    exact = vectors @ vectors.T >= 0.9
    assert len(row) >= 0.95 * (exact.sum() - 900)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=60))
def test_spanning_forest(links):
    a, b = np.array(links, dtype=np.int64).T
    x, y = hnsw.spanning_forest(a, b)
    nodes = {n for link in links for n in link}
    assert grouped(nodes, zip(a.tolist(), b.tolist())) == grouped(nodes, zip(x.tolist(), y.tolist()))
    assert len(x) == len(nodes) - len(set(grouped(nodes, links).values()))
