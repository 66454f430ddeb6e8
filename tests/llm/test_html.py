"""Main text of small pages, and of the given ones against their marked article."""

import re
import time
from html import unescape

import pytest
from pyspark.sql import types as T

from skyledger.llm import html, queries

LONG = "a paragraph that is long enough to be seen as text of the page itself, really " * 2
PAGES = [
    (None, ""),
    ("", ""),
    ("plain words", "plain words"),
    ("<body><p>A short note about cats.</p></body>", "A short note about cats."),
    (f'<div class="has-sidebar"><p>{LONG}</p></div>', LONG.strip()),
    (f'<div class="no-sidebar content"><article><p>{LONG}</p></article></div><div class="sidebar"><p>{LONG}</p></div>', LONG.strip()),
    (f'<div class="header main"><p>menu</p><article><p>{LONG}</p></article></div>', LONG.strip()),
    (f'<article><p>{LONG}</p><div class="related-work"><p>see others</p></div></article>', f"{LONG.strip()}\nsee others"),
    (f'<div><p>{LONG}</p><div id="comments-list"><p>{LONG}</p></div><div class="ad-slot-3">buy {LONG}</div></div>', LONG.strip()),
    (f"<article><p>x</p></article><p>{LONG}</p><p>{LONG * 5}</p>", f"x\n{(LONG * 5).strip()}"),
    ('<p title="a<b>c">q</p><p title=\'x>"\'>r</p>', "q\nr"),
    ("<article>x", "x"),
    ("<article><p>a &amp; b&nbsp;&#x41;<p>c<br>d</p>e</article>", "a & b A\nc d\ne"),
    ("<article><p>1 < 2 and 3 > 2</p><!-- <p>no</p> --><p>ok</article>", "1 < 2 and 3 > 2\nok"),
    ('<script>var t="</p><article>no";</script><article><p>yes</p></article>', "yes"),
    ("<article><p>cut off <b>here</p><p>tail <a hre", "cut off here\ntail"),
    ('<nav><a href="/">home</a></nav><article><header><h1>T</h1></header><p>x</p><aside>no</aside><p>y</p></article><footer>z</footer>', "T\nx\ny"),
    ('<main><p>x</p><div class="ad-slot">buy</div><form>f</form><section id="comments"><p>c</p></section></main><p>after</p>', "x"),
    ('<article><p title="a > b">q</p><ul><li>one<li>two</ul><table><tr><td>1<td>2</table></article>', "q\none\ntwo\n1 2"),
    (f'<div><a href="/">Home</a> <a href="/x">About</a></div><div><p>{LONG}</p><p>short</p></div>', f"{LONG.strip()}\nshort"),
    ("<article>" + "<p>w</p>" * 30_000 + "</article>", "\n".join(["w"] * 30_000)),
    ("<div>" * 5000 + "<!--" * 5000, ""),
]


@pytest.mark.parametrize("page, want", PAGES[1:])
def test_main_text(page, want):
    assert html.main_text(page) == want


def test_spans_surge_and_dive():
    weights = [0, 5, 0, 0, 0, 60, 60, 1, 0, 0, 0, 9]
    assert list(html.spans(weights, 3, 86)) == [(5, 8)]
    assert list(html.spans([1, 0, 0, 2], 3, 1)) == [(0, 4)] and list(html.spans([], 3, 1)) == []


def test_frame(spark):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("html", "text", "url")])
    df = spark.createDataFrame([(p, "own", "u") for p, _ in PAGES] + [("<article>x", None, None)], schema)
    rows = html.extract(df).collect()
    assert sorted(r.text for r in rows) == sorted([w for _, w in PAGES] + ["x"])
    assert all(r.n_chars == len(r.text) for r in rows)
    assert html.extract(spark.createDataFrame([], schema)).count() == 0


def test_given_pages(spark):
    folder = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = queries.QUERIES["op1_html_extraction"](spark, folder).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search("<article>(.*?)(?:</article>|$)", pages[r.page_id], re.DOTALL)[1]
        parts = (" ".join(unescape(re.sub("<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)\b[^>]*>", article))
        assert r.text == "\n".join(x for x in parts if x)


def test_given_pages_without_marks(spark):
    """The distribution alone finds the article: 0.95 of all lines at least."""
    pages = [r.html or "" for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    same = total = 0
    for page in pages:
        want = html.main_text(page).split("\n")
        got = html.main_text(re.sub("<(/?)(?:article|main)", r"<\1div", page)).split("\n")
        same += sum(x == y for x, y in zip(got, want)) if len(got) == len(want) else len(set(got) & set(want))
        total += max(len(got), len(want))
    assert total > 1000 and same >= 0.95 * total


@pytest.mark.parametrize("part", ['<div class="', "<script ", "<p a='", "<b x=\"'", "<", "</p ", "<!-", "<div><a "])
def test_unclosed_markup_takes_linear_time(part):
    start = time.perf_counter()
    html.main_text(part * 80_000 + ">")
    html.main_text(part * 80_000)
    assert time.perf_counter() - start < 8
