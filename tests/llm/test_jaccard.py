"""The similarity join against all pairs of sets, and its parts."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from skyledger.llm import graph, jaccard, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def joined(rows):
    """(doc_id, size, component) of each row by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                label[top(i)] = top(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids[top(i)] = min(ids.get(top(i), d), d)
    return sorted((d, len(s), ids[top(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def corpus(seed):
    """Chains of near copies, copies, shared passages and awkward texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = rng.choices(vocabulary, k=60)
    texts = [None, "", " \n", "one", "One", "a b", "a b c d", "A B C D", "a b c d e", "é É a b c", "é é a b c", "x " * 300, "x " * 700]
    for _ in range(12):
        words = rng.choices(vocabulary, k=rng.randrange(8, 220)) + passage * rng.randrange(2)
        for _ in range(rng.randrange(1, 9)):
            texts.append(" ".join(words))
            words = list(words)
            for _ in range(rng.randrange(0, max(1, len(words) // 40) + 1)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.4:
                words = words + rng.choices(vocabulary, k=rng.randrange(len(words) // 8 + 1))
    ids = rng.sample(range(10_000), len(texts))
    return list(zip(ids, texts))


@pytest.mark.parametrize("seed", range(2))
def test_query(spark, tmp_path, seed):
    rows = corpus(seed)
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op7_jaccard_join"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == joined(rows)


def test_sets():
    texts = [t for _, t in corpus(3)]
    hashes = {}
    at = 0
    for low, found, bounds in jaccard.shingle_sets(pa.array(texts)):
        assert low == at
        for i in range(len(bounds) - 1):
            own = found[bounds[i] : bounds[i + 1]]
            want = shingles(texts[at])
            assert len(own) == len(want) == len(set(own.tolist()))
            hashes.setdefault(frozenset(want), tuple(own))
            assert hashes[frozenset(want)] == tuple(own)
            at += 1
    assert at == len(texts) and len(set(hashes.values())) == len(hashes)


def test_tree_finds_all_pairs_that_may_link():
    rng = np.random.default_rng(4)
    base = rng.poisson(8, (30, jaccard.GROUPS))
    held = np.concatenate([np.maximum(0, base + rng.integers(-1, 2, base.shape)) for _ in range(6)]).astype(np.int64)
    want = {(i, j) for i in range(len(held)) for j in range(i) if jaccard.may_link(held[i], held[j])}
    got = [(max(i, j), min(i, j)) for x, y in jaccard.Tree(held).pairs() for i, j in zip(x.tolist(), y.tolist())]
    assert len(got) == len(set(got)) and set(got) == want and 100 < len(want) < len(held) ** 2 / 4
    assert list(jaccard.Tree(held[:1]).pairs()) == [] or all(len(x) == 0 for x, _ in jaccard.Tree(held[:1]).pairs())


def test_large_groups_of_near_copies_are_compared_in_bounded_memory():
    rng = np.random.default_rng(8)
    held = (rng.poisson(2, jaccard.GROUPS) + rng.integers(0, 2, (1500, jaccard.GROUPS)) * (rng.random((1500, jaccard.GROUPS)) < 0.05)).astype(np.int32)
    tree, pairs = jaccard.Tree(held), 0
    tracemalloc.start()
    for x, _ in tree.pairs():
        pairs += len(x)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert pairs == 1500 * 1499 // 2 and peak < 24e6


def test_powers_of_slices_are_made_once(monkeypatch):
    made = []
    powers = jaccard._powers
    monkeypatch.setattr(jaccard, "_powers", lambda n: made.append(n) or powers(n))
    jaccard._slice_powers.cache_clear()
    long = " ".join(f"w{i}" for i in range(200_000))
    for texts in (["a b c d e f"], ["b c", None], [long, "a b c d e f"]):
        last = [found[bounds[i] : bounds[i + 1]].tolist() for _, found, bounds in jaccard.shingle_sets(pa.array(texts)) for i in range(len(bounds) - 1)]
    assert made == [jaccard.SLICE_BYTES, len(long)] and len(last[0]) == 199_996 and len(last[1]) == 2


def test_points_bound_the_overlap():
    rng = np.random.default_rng(7)
    for n in (0, 1, 5, 500, 6000):
        a = np.unique(rng.integers(0, 2**63, n, np.uint64))
        b = np.unique(np.concatenate([a[: n - n // 9], rng.integers(0, 2**63, n // 20, np.uint64)]))
        p, q = (jaccard.points(x, np.array([0, len(x)]))[0] for x in (a, b))
        assert len(p) >= max(jaccard.GROUPS, n / 4) and jaccard.folded(p, jaccard.GROUPS).sum() == len(a)
        m = min(len(p), len(q))
        assert np.minimum(jaccard.folded(p, m), jaccard.folded(q, m)).sum() >= len(np.intersect1d(a, b))


def test_rarity_order_decides_no_link():
    """Any classes give two linked sets a key in common."""
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        a = rng.integers(0, 2**63, n, np.uint64)
        b = np.concatenate([a[rng.random(n) > 0.1], rng.integers(0, 2**63, int(rng.integers(0, n // 9 + 1)), np.uint64)])
        both = len(np.intersect1d(a, b))
        if 100 * both < 80 * (len(a) + len(b) - both):
            continue
        classes = rng.integers(0, 3, 1 << jaccard.COUNTER_BITS).astype(np.uint8)
        found = [set(jaccard.keys(np.sort(x), np.array([0, len(x)]), classes)[1].tolist()) for x in (a, b)]
        assert found[0] & found[1]


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(200, 260)] + [(5, 5), (9, 1), (1, 9)] + [(500, 500 + i) for i in range(40)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {9: 1, **{i: 200 for i in range(201, 261)}, **{500 + i: 500 for i in range(1, 40)}}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_awkward_rows(spark):
    schema = T.StructType([T.StructField(n, T.LongType() if n == "doc_id" else T.StringType()) for n in ("doc_id", "text", "node", "sig")])
    text = "a b c d e f g h i j k l"
    docs = [(3, text, "own", ""), (3, text, "own", ""), (4, text.upper(), None, None), (None, text, "", ""), (None, None, "", ""), (7, None, "", "")]
    df = spark.createDataFrame(docs, schema)
    got = jaccard.near_duplicates(df.select("doc_id", "text")).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [
        (0, 0, 0), (0, 8, 3), (3, 8, 3), (3, 8, 3), (4, 8, 3), (7, 0, 7)
    ]
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    assert jaccard.keep_one(spark.createDataFrame([], schema)).count() == 0
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, ""), (0, text), (3, text), (7, "")]


def test_one_row_of_each_component_stays(spark):
    """Rows that share an id are told apart by their texts; repeated rows leave one."""
    base = [f"w{i}" for i in range(60)]
    a, near, other = " ".join(base), " ".join(base[:-1] + ["x"]), " ".join(f"v{i}" for i in range(60))
    rows = [(1, a, "s"), (5, near, "s"), (5, other, "s"), (6, other, "s"), (1, near, "s"), (1, other, "t")]
    rows += [(2, "  ", "s"), (2, "  ", "s"), (None, a, "s"), (9, None, None), (0, "lone words", "z"), (0, "lone words", "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(map(tuple, kept.collect()), key=repr)
    first = [r for r in rows if r[0] == 1 and r[1] in (a, near)]
    assert [r for r in got if r[0] == 1 and r[1] in (a, near)] in [[r] for r in first]
    want = [r for r in rows if r[0] in (2, 9, None) or r == (1, other, "t")] + [(0, "lone words", "b")]
    assert sorted([r for r in got if r not in first], key=repr) == sorted(want, key=repr)
    assert jaccard.keep_one(docs.where("false")).collect() == []
