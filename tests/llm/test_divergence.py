"""Source divergence against exact sums over dense tables, and against SQL."""

import random
import re
from collections import Counter, defaultdict

import compare
import duckdb

from skyledger.llm import divergence, queries

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "lang string, source string, text string"


def plain(rows, least_docs, top=50):
    groups, docs, seen = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        words = TERM.findall((text or "").translate(LOWER))
        groups[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
        seen[lang or ""].add(source or "")
    out = set()
    for lang, sources in seen.items():
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        total = {t: sum(groups[lang, s][t] for s in sources) for t in kept}

        def frequencies(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // (n + 5 * len(kept)) for t in kept}

        q, p = frequencies(total), {s: frequencies(groups[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            more = [(q[t] - p[s][t], t) for t in kept if groups[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(more)[:top])):
                out |= {(lang, s, part, item, -value, i + 1) for i, (value, item) in enumerate(found)}
    return out


def corpus(n=400):
    rng = random.Random(13)
    vocabulary = [f"{a}{b}" for a in ("wort", "É", "漢", "Zz", "x") for b in "abcdefgh"]
    rows = [(None, None, None), ("de", None, ""), ("de", "s1", "42 _ - "), ("en", "", "İ K ſ"), ("solo", "one", "a b")]
    for _ in range(n):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s2", "s2", "é", "￿", "😀", None])
        at = rng.randrange(30)
        words = rng.choices(vocabulary[at : at + 8], k=rng.randrange(30))
        rows.append((lang, source, rng.choice([" ", "\n", "1", "_"]).join(words)))
    return rows + rows[50:60]


def found(spark, rows, **options):
    got = divergence.audit(spark.createDataFrame(rows, SCHEMA).repartition(3), **options).collect()
    assert len(got) == len(set(got))
    return set(map(tuple, got))


def test_as_by_dense_sums(spark, monkeypatch):
    rows = corpus()
    assert found(spark, rows, least_docs=5) == plain(rows, 5)
    monkeypatch.setattr(divergence, "PEERS", 2)
    assert found(spark, rows, least_docs=3, top=4, block=20) == plain(rows, 3, 4)
    assert found(spark, rows, least_docs=10**6) == plain(rows, 10**6)


def test_counts_sent_in_several_parts(monkeypatch):
    import pyarrow as pa

    rows = [(x or "", y or "", z or "") for x, y, z in corpus(100)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["lang", "source", "text"])
    want = None
    for size in (10**6, 40, 1):
        monkeypatch.setattr(divergence, "FLUSH", size)
        sums = defaultdict(lambda: [0, 0])
        for out in divergence.count_terms(iter([batch])):
            for r in out.to_pylist():
                sums[r["lang"], r["source"], r["term"]][0] += r["n"]
                sums[r["lang"], r["source"], r["term"]][1] += r["docs"]
        want = want or dict(sums)
        assert dict(sums) == want and len(want) > 100


def test_terms():
    text = "Ab1cD é__ÉX İiK\x7fz[q]`w{~"
    assert [t.decode() for t in divergence.terms(text)] == TERM.findall(text.translate(LOWER))


def test_no_rows_and_a_large_count(spark):
    assert found(spark, []) == set()
    n, v = 9 * 10**17, 10**6
    row = spark.range(1).select(divergence.frequency(*(divergence.F.lit(x).cast("bigint") for x in (n - 7, n, v))).alias("p"))
    assert row.first().p == 1 + 10**9 * (n - 2) // (n + 5 * v)


def test_query_and_sql(spark, tmp_path):
    rows = [(i, *r) for i, r in enumerate(corpus(900))]
    spark.createDataFrame(rows, "doc_id bigint, " + SCHEMA).repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = queries.QUERIES["op13_source_divergence"](spark, str(tmp_path))
    assert compare.spark_rows(got) == compare.sql_rows(con, queries.ORACLES["op13_source_divergence"])
    assert set(map(tuple, got.collect())) == plain([r[1:] for r in rows], 30)


def test_long_text_ties_and_clashing_columns(spark):
    """A text of a million terms; equal values rank by item; other columns play no part."""
    rows = [("en", "long", "a b " * 500_000), ("en", "short", "a b c"), ("en", "third", "a b c")]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs = docs.withColumns({c: divergence.F.lit("x") for c in ("term", "n", "value", "p", "block", "peers", "doc_id")})
    got = set(map(tuple, divergence.audit(docs, least_docs=1).collect()))
    assert got == plain(rows, 1)
    assert [r[3] for r in sorted(got, key=lambda r: r[5]) if r[1:3] == ("long", "pair")] == ["short", "third"]
