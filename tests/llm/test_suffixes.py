"""Removal of repeated passages against every 50-byte string by brute force."""

import hashlib
import random

from pyspark.sql import functions as F

from skyledger.llm import common, queries, suffixes

RNG = random.Random(3)
SHARED = ["".join(RNG.choices("abcdé 漢\n", k=n)) for n in (50, 60, 130, 900)]


def noise(n):
    return "".join(RNG.choices("abcdefgh é\n", k=n))


def corpus():
    texts = ["", None, "short", "x" * 49, "x" * 50, "x" * 400, "ab" * 200, noise(3000)]
    texts += [noise(40) + RNG.choice(SHARED) + noise(RNG.randrange(90)) + RNG.choice(SHARED) for _ in range(30)]
    texts += [texts[9], texts[9], texts[10][7:], texts[11][:-3], noise(20000) + SHARED[3] + noise(500)]
    ids = list(range(len(texts)))
    RNG.shuffle(ids)
    return list(zip(ids, texts))


def plain(rows):
    """(n_bytes, n_removed, n_spans, kept_sha256) of each row, null ids last."""
    order = lambda r: (r[0] is None, r[0] or 0)
    least = {}
    for i, text in sorted(rows, key=order):
        data = (text or "").encode()
        for k in range(len(data) - 49):
            least.setdefault(data[k : k + 50], order((i,)))
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 49):
            if least[data[k : k + 50]] < order((i,)):
                gone[k : k + 50] = b"\1" * 50
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        kept = hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest()
        out.append((i, len(data), sum(gone), spans, kept))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    return sorted(map(tuple, suffixes.repeated_passages(docs, **options).collect()), key=repr)


def test_all_cases_as_by_brute_force(spark, monkeypatch):
    rows = corpus()
    assert found(spark, rows) == plain(rows)
    rows += [rows[0], rows[20], (None, rows[20][1]), (None, None)]
    assert found(spark, rows, buckets=3) == plain(rows)


def test_a_crowd_of_runs_at_one_anchor(spark):
    """More first runs at one anchor than are sent: their windows are compared instead."""
    middle = "0123456789abcdefghijABCDEFGHIJ0123"
    rows = [(i, noise(30) + middle + noise(30)) for i in range(suffixes.CROWD + 60)]
    rows += [(1000 + i, t[5:]) for i, t in rows[:40]]
    assert found(spark, rows) == plain(rows)


def test_no_rows_and_further_columns(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, id string, h int, gone string")
    assert suffixes.repeated_passages(docs).collect() == []
    docs = spark.createDataFrame([(1, SHARED[3]), (2, SHARED[3])], "doc_id bigint, text string")
    docs = docs.withColumns({n: F.lit("x") for n in ("id", "h", "gone", "open", "block", "n_bytes")})
    got = {r.doc_id: r.n_removed for r in suffixes.repeated_passages(docs).collect()}
    assert got == {1: 0, 2: len(SHARED[3].encode())}


def test_query(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op3_repeated_passages"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows)


def test_a_text_of_more_than_a_slice(spark):
    """Passages at both ends and across the slice bound of a text of 1.3 MB."""
    long = noise(700_000) + SHARED[3] + noise(350_000) + SHARED[2] + noise(200)
    assert len(long.encode()) > common.SLICE_BYTES
    rows = [(2, long), (1, long[-700:]), (3, long[500_000:500_400] + noise(50)), (4, SHARED[3] + noise(9)), (5, long[:300])]
    assert found(spark, rows) == plain(rows)


def test_spans_are_joined():
    spans = suffixes.np.array([[5, 9], [0, 3], [3, 4], [6, 7], [20, 30], [8, 12]])
    assert suffixes.joined(spans).tolist() == [[0, 4], [5, 12], [20, 30]]
    assert suffixes.joined(spans[:1]).tolist() == [[5, 9]]


def test_buckets_grow_with_the_texts(spark, monkeypatch):
    rows = corpus()
    texts = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 1000)
    size = sum(len((t or "").encode()) for _, t in rows)
    assert suffixes.bucket_count(texts) == -(-size // 1000) > 30
    assert found(spark, rows) == plain(rows)
    plan = suffixes.repeated_passages(texts)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
