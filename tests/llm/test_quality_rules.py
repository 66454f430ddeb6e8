"""Quality measures against row-by-row Python, on awkward texts."""

import re

import pytest
from pyspark.sql import types as T

from skyledger.llm import quality

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    None,
    "",
    " \t\r\n\x0b\x0c ",
    "one",
    "a b c a b c",
    "a a a a a",
    "x\ny\nx\n \n\nx\r\n- z\n• w...\nend…  ",
    "### $$ %%% <b> | & ** plain",
    " nbsp stays one word ",
    "the and of " * 30 + "é" * 50,
    " ".join(f"w{i % 997}" for i in range(30_000)),
    "same words again and again " * 4000,
    " ".join(f"the{i} a{i} of word{i}" for i in range(20)),
]


def measures(text):
    text = text or ""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "base_failed": len(words) < 50 or 100 * len(covered) > 50 * len(words),
    }


@pytest.fixture(scope="module")
def docs(spark):
    fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("kept", T.StringType()), ("n_words", T.LongType())]
    schema = T.StructType([T.StructField(*f) for f in fields])
    rows = [(i, t, "own", 7) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], None, None)]
    return spark.createDataFrame(rows, schema)


def test_measures(docs):
    got = quality.judge(docs.select("doc_id", "text")).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        want = measures(TEXTS[r.doc_id])
        assert {k: r[k] for k in want} == want, r.doc_id
        assert not (r.kept and r.base_failed)


def test_filter_keeps_columns(spark, docs):
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {12} and kept.first().n_words == 7
    assert quality.keep_good(spark.createDataFrame([], docs.schema)).count() == 0


def test_no_python_in_plan(docs):
    plan = quality.judge(docs.select("text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
