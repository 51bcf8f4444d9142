"""Operators 11, 12 and 13 against plain Python."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cascadia.llm import context_trees, merkle, prefix_trie
from tests.llm.conftest import prose


def crc(value) -> int:
    return zlib.crc32(str(value).encode())


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# Operator 11

TURNS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
        *(T.StructField(n, T.StringType()) for n in ("node", "path", "end", "pos", "digest", "kind")),
    ]
)


def turn_frame(spark, rows):
    return spark.createDataFrame([(*r, *"nperdk") for r in rows], TURNS)


def brute_trie(rows):
    """Every node as the registered query returns it, from whole paths in memory."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, digest, (role, text)))
    turns = {c: [t[-1] for t in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, v in turns.items():
        h = crc(c) % 4
        base = c - int(math.fmod(c, 20))
        paths[c] = tuple(turns.get(base, [])[:h] + v[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, p in paths.items():
        ends[p].append(c)
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    n_children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            n_children[node[:-1]] += 1
    for node in members:
        words = len(node[-1][1].encode().split()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += n_children[node] == 0
            saved[node[:d]] += (len(members[node]) - 1) * words
    return sorted(
        (
            min(m), len(node), min(members[node[:-1]]) if node else -1, len(m), n_children[node], leaves[node], saved[node],
            sha(",".join(map(str, sorted(ends[node])))),
        )
        for node, m in members.items()
    )


def trie_rows(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert df.columns == names
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def some_turns(seed, n, longest=6):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(["hi", "one two", "a b c"])))
    return rows


@pytest.mark.parametrize("path_turns, shard_turns", [(256, 1 << 18), (256, 12), (2, 9), (1, 3)])
def test_trie(spark, path_turns, shard_turns):
    odd = [
        (-45, 0, "user", "negative ids"),
        (-45, 1, "user", "share a base, too"),
        (-40, 0, "user", "their base"),
        (7_000, None, None, None),
        (7_000, 0, "", ""),
        (7_001, 1, "user", "same turn"),
        (7_001, 1, "user", "number twice"),
        (7_001, 1, "user", "number twice"),
        (7_002, 3, "system", prose(5, 30_000)),
        (None, 0, "user", "no conversation"),
        *[(8_000 + 20 * k, t, "user", "hi") for k in range(40) for t in range(3)],
        *[(9_000, t, "user", "hi") for t in range(40)],
        *[(9_020, t, "user", "hi" if t != 30 else "ho") for t in range(40)],
    ]
    rows = some_turns(1, 120) + odd
    random.Random(2).shuffle(rows)
    got = prefix_trie.conversation_trie(turn_frame(spark, rows), path_turns, shard_turns)
    assert trie_rows(got) == brute_trie(rows)


def test_trie_of_nothing(spark):
    empty = turn_frame(spark, [(None, 0, "user", "x")])
    assert prefix_trie.conversation_trie(empty).count() == 0
    assert prefix_trie.conversation_trie(empty.limit(0)).count() == 0


def test_turnless_conversation(spark):
    conv = next(c for c in range(1, 1000) if crc(c) % 4 == 3 and c % 20)
    rows = [(conv, 0, "user", "lost"), (2_000, 0, "user", "kept")]
    assert trie_rows(prefix_trie.conversation_trie(turn_frame(spark, rows))) == brute_trie(rows)


@pytest.mark.parametrize("n, deep", [(1, 1), (40, 40), (5_000, 30), (40_000, 4)])
def test_findclose(n, deep):
    rng, bits, open_ = random.Random(n), [1], [0]
    close = {}
    while len(bits) < 2 * n or open_:
        if len(bits) - len(close) < n and (len(open_) <= 1 or (len(open_) < deep and rng.random() < 0.55)):
            open_.append(len(bits))
            bits.append(1)
        else:
            close[open_.pop()] = len(bits)
            bits.append(0)
    opens = np.flatnonzero(bits)
    found = prefix_trie.Parentheses(np.array(bits, dtype=np.int8)).findclose(opens)
    assert found.tolist() == [close[i] for i in opens]


# Operator 12


def brute_manifest(rows):
    """doc_id, leaf, subroot, root, proof, folded root and verdict per row ``(id, source, lang, n, text)``."""

    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
        return out

    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([r[2] for r in sorted(groups[g], key=lambda r: r[:3])]) for g in order}
    top = levels([trees[g][-1][0] for g in order])
    root, out = top[-1][0], []
    for rank, g in enumerate(order):
        for place, (_, _, own, row) in enumerate(sorted(groups[g], key=lambda r: r[:3])):
            hit = row[0] is not None and row[3] is not None and crc(row[0]) % 7 == 0
            digest, proof = leaf((*row[:3], row[3] + 1, row[4]) if hit else row), ""
            for tree, at in ((trees[g], place), (top, rank)):
                for nodes in tree[:-1]:
                    beside = nodes[at ^ 1] if at ^ 1 < len(nodes) else ""
                    proof += beside
                    digest = sha(beside + digest if at & 1 else digest + beside)
                    at >>= 1
            out.append((row[0], own, trees[g][-1][0], root, sha(proof), digest, digest == root))
    return sorted(out, key=str)


MANIFEST = "doc_id long, source string, lang string, n_chars long, text string, hash string, parent string, steps string"


def audited(spark, rows, span):
    docs = spark.createDataFrame([(*r, "h", "p", "s") for r in rows], MANIFEST)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    altered = F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return sorted((tuple(r) for r in merkle.audit(docs, {"n_chars": altered}, span=span).collect()), key=str)


@pytest.mark.parametrize("span", [1, 3, 10])
def test_manifest(spark, span):
    rng = random.Random(3)
    rows = [(i, rng.choice("ab"), rng.choice(["en", "en", "de", None, "", "é"]), rng.choice([i, None]), prose(i, 5)) for i in range(150)]
    rows += [(500, None, "fr", 7, None), (501, "s", "zz", 1, ""), (None, None, None, None, None)]
    rows += [(9, "a", "en", 3, "again")] * 4 + [(600, "s", "en", 2, "long " * 50_000), (601, "s", "en", 2, "漢字🙂")]
    assert audited(spark, rows, span) == brute_manifest(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 8, 9])
def test_small_manifests(spark, n):
    rows = [(i, "s", "en", i, "t") for i in range(n)]
    assert audited(spark, rows, 2) == brute_manifest(rows)


def test_manifest_of_nothing(spark):
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "1000000"
    docs = spark.createDataFrame([], MANIFEST)
    assert merkle.audit(docs, {}).count() == 0
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "1000000"


# Operator 13


def folded(text):
    plain = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return b" ".join(plain.split()) + b"\n"


def brute_scores(rows, depth):
    """Tokens, known tokens, unigram and context-tree scores by dictionaries over single bits."""
    texts = [(k, folded(t), k is not None and crc(k) % 7 == 2) for k, t in rows]
    counts = [defaultdict(lambda: [0, 0]) for _ in range(depth + 1)]

    def decisions(seq):
        data = b"\n" * depth + seq
        for i in range(depth, len(data)):
            node = 1
            for j in range(7, -1, -1):
                bit = data[i] >> j & 1
                yield [(data[i - k : i], node) for k in range(depth + 1)], bit
                node = 2 * node + bit

    words, n = defaultdict(int), 0
    for _, seq, held in texts:
        if not held:
            for path, bit in decisions(seq):
                for level, node in zip(counts, path):
                    level[node][bit] += 1
            for w in [*seq.split(), None]:
                words[w] += 1
                n += 1
    stop = [{} for _ in counts]
    below = defaultdict(float)
    for d in range(depth, -1, -1):
        above = defaultdict(float)
        for (context, node), (a, b) in counts[d].items():
            own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
            weighted = own if d == depth else float(np.logaddexp(own, below[context, node])) - math.log(2)
            stop[d][context, node] = 1 if d == depth else math.exp(own - math.log(2) - weighted)
            above[context[1:], node] += weighted
        below = above
    out = {}
    for k, seq, held in texts:
        score = 0.0
        for path, bit in decisions(seq):
            seen = [d for d, node in enumerate(path) if node in counts[d]]
            p, rest = (0.0, 1.0) if seen else (0.5, 0.0)
            for d in seen:
                pair = counts[d][path[d]]
                share = 1 if d == seen[-1] else stop[d][path[d]]
                p += rest * share * (pair[bit] + 0.5) / (sum(pair) + 1)
                rest *= 1 - share
            score += math.log10(p)
        tokens = [*seq.split(), None]
        base = sum(math.log10((words.get(w, 0) + 1) / (n + len(words) + 1)) for w in tokens)
        out[k] = (held, len(tokens), sum(w in words for w in tokens), n, base, score, len(seq))
    return out


def scored(docs, **settings):
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return context_trees.score_documents(docs, held_out, **settings).collect()


def same_scores(got, expected):
    assert len(got) == len(expected)
    for r in got:
        held, n, known, total, base, score, size = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(score, rel=1e-9)
        assert r.bits_per_byte == pytest.approx(-score / math.log10(2) / size, rel=1e-9)


@pytest.mark.parametrize("settings", [{}, {"depth": 2}, {"block_bytes": 2_000, "bucket_entries": 300}])
def test_scores(make_docs, settings):
    rows = [(i, prose(i % 23, 40)) for i in range(60)]
    rows += [(None, prose(3, 10)), (100, None), (101, ""), (102, " \n\t"), (103, "É漢字🙂 a\x1cb\x85"), (104, "ABC abc\nABC"), (105, "x" * 4000)]
    same_scores(scored(make_docs(*rows), **settings), brute_scores(rows, settings.get("depth", context_trees.DEPTH)))


def test_scores_of_repeated_rows(make_docs):
    rows = [(1, "same words"), (1, "same words"), (2, "same words")]
    got = scored(make_docs(*rows))
    assert len(got) == 3 and len({r.score for r in got}) == 1 and {r.n_known for r in got} == {3}


def test_scores_without_training(make_docs):
    held = next(i for i in range(100) if crc(i) % 7 == 2)
    (row,) = scored(make_docs((held, "two words")))
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)
    assert row.bits_per_byte == pytest.approx(8)
    assert scored(make_docs((1, "x")).limit(0)) == []


def test_long_texts_in_slices(make_docs):
    long = prose(77, 400_000)
    whole, twice = scored(make_docs((1, long), (9, "b")), block_bytes=1 << 30), scored(make_docs((1, long), (9, "b")), block_bytes=1 << 20)
    assert {r.doc_id: r.score for r in whole} == pytest.approx({r.doc_id: r.score for r in twice})


def test_probabilities_sum_to_one(spark):
    """Over all bytes after one context, whatever the training."""
    texts = [prose(i, 30).encode() for i in range(20)]
    data, sizes = context_trees.byte_sequence(texts, 4)
    grams, counts = np.unique(context_trees.grams_of(data, sizes, 4), return_counts=True)
    levels = context_trees.grow(grams, counts, 4, 0)
    for context in (0, 0x0A0A0A0A, int(grams[5]) >> 8, int(grams[-1]) >> 8):
        every = np.arange(256, dtype=np.uint64) | np.uint64(context << 8)
        assert np.sum(10 ** context_trees.log10_bytes(every, levels)) == pytest.approx(1)
