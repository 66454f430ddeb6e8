"""Periodic runs against all pairs of bounds by brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from skyledger.llm import periods, queries

RNG = random.Random(12)


def plain_runs(words):
    """(start, length, period) of every run, by trying each period at each place."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            whole = words[i : j + q]
            smaller = any(all(a == b for a, b in zip(whole, whole[p:])) for p in range(1, q))
            if len(whole) >= max(6, 4 * q) and not smaller:
                out.append((i, len(whole), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def rewritten(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def plain(doc_id, text):
    words = rewritten(doc_id, (text or "").encode().split())
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    return {
        "doc_id": doc_id,
        "n_runs": len(runs),
        "start": best[0],
        "length": best[1],
        "period": best[2],
        "exponent_milli": 1000 * best[1] // best[2] if runs else None,
        "runs_sha256": hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    }


def cases():
    block = lambda n, k=40: RNG.choices([f"w{i}" for i in range(k)], k=n)
    for _ in range(50):
        yield RNG.choices("ab", k=RNG.randrange(120))
        yield RNG.choices("a" * 12 + "b", k=RNG.randrange(200))
    for q in [*range(1, 40), 63, 64, 65, 100]:
        for k in (2, 40):
            extra = RNG.randrange(q)
            x = block(q, k)
            yield block(RNG.randrange(9), k) + x * 4 + x[:extra] + block(RNG.randrange(9), k)
            yield x * 3 + x[:-1]
    inner = ["a"] * 9 + ["b", "a", "b"]
    yield inner * 5 + ["c"] + (["a"] * 30 + ["b"]) * 6 + inner * 4
    yield (block(7) * 5 + ["x"]) * 4
    a, b = ["a"], ["a", "b"]
    while len(b) < 400:
        a, b = b, b + a
    yield b


@pytest.mark.parametrize("seed", range(2))
def test_runs_of_sequences(seed):
    RNG.seed(seed)
    for words in cases():
        numbers = np.unique(words, return_inverse=True)[1].astype(np.int64) if words else np.zeros(0, np.int64)
        got = [(s, e - s, q) for s, e, q in periods.runs_of(numbers, len(words)).tolist()]
        assert got == plain_runs(words), words


def corpus():
    rng = random.Random(5)
    texts = [None, "", " \n\t", "one", "a " * 7, "x y " * 4, "é\x0bé\x0cé\ré é é", "nb sp nb sp " * 9, "漢 字 " * 8]
    texts += [" ".join(rng.choices(["a", "b", "c"], k=rng.randrange(300))) for _ in range(120)]
    texts += [" ".join(rng.choices(["der", "die"], k=50)) + " x y z" * rng.randrange(3, 9) + "\n\tend" for _ in range(60)]
    return [(i, t) for i, t in enumerate(texts)]


def test_query_as_by_brute_force(spark, tmp_path):
    rows = corpus() + [(4, "a " * 7), (None, "z " * 12)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = [{k: v for k, v in r.asDict().items() if k != "n_words"} for r in queries.QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted((plain(*r) for r in rows), key=repr)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows)


def test_texts_of_several_slices(spark, monkeypatch):
    monkeypatch.setattr(periods, "SLICE", 500)
    made = periods._measure([t or "" for _, t in corpus()], [None] * len(corpus()), None)
    low = 0
    texts = [t or "" for _, t in corpus()]
    for a, b in periods._slices(texts):
        assert a == low
        part = periods._measure(texts[a:b], [None] * (b - a), None)
        assert [x.to_pylist() for x in part] == [x.slice(a, b - a).to_pylist() for x in made]
        low = b
    assert low == len(texts)


def test_long_texts():
    """A million words, of one word, of a long period, and of unrelated words."""
    n = 1_000_000
    assert periods.runs_of(np.zeros(n, np.int64), n).tolist() == [[0, n, 1]]
    numbers = np.random.default_rng(1).integers(0, 1 << 40, n)
    assert len(periods.runs_of(numbers, n)) == 0
    q = 123_457
    assert periods.runs_of(np.resize(numbers[:q], n), n).tolist() == [[0, n, q]]


def test_further_columns_and_no_rows(spark):
    schema = "doc_id bigint, text string, runs int, n_words string, _text string, `a.b` int"
    assert periods.find_runs(spark.createDataFrame([], schema)).collect() == []
    got = periods.find_runs(spark.createDataFrame([(1, "a " * 9, 5, "x", "own", 3)], schema))
    assert got.columns == ["doc_id", "_text", "a.b", "n_words", "runs", "collapsed"]
    row = got.first()
    assert (row["_text"], row["a.b"], row["n_words"], row["collapsed"]) == ("own", 3, 9, "a")
    assert [tuple(r) for r in row["runs"]] == [(0, 9, 1)]
