"""Main text of web pages by the distribution of text over lines.

Markup is stripped to lines (one per block element) in page order. A line weighs its text outside
links; lines of menus, notices, adverts, forms, comments and the like weigh nothing. Sums over a sliding
window of lines show where text surges and where it dives to nothing, and the lines between that weigh
something are kept. What counts as a surge is measured on the page itself, so short articles surge too.
If a page marks its article or main part, lines in it weigh more, and others only what they have beyond a
long paragraph.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from skyledger.llm.common import map_text

WINDOW = 3
#: Characters in a window that count as text on any page; on a page whose fullest window has little more,
#: that window's share of one in SHARE does.
SURGE, SHARE = 86, 3
#: Characters of a line outside the marked article that weigh nothing.
OUTSIDE = 4 * SURGE

#: Names of HTML elements, and words in their class, id or role that tell their use.
RAW = "script style noscript template textarea title iframe svg math object canvas select".split()
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section summary table "
    "tbody tfoot thead tr ul".split()
)
PLAIN = frozenset("p span b i li".split())
SPACED = frozenset("br td th img input button label".split())
ASIDE = frozenset("nav footer aside form head menu dialog button search".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
USE = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert alerts popup modal overlay newsletter subscribe signup login side sidebar widget widgets menu nav navbar "
    "navigation breadcrumb breadcrumbs footer header masthead comment comments commentlist disqus replies respond share sharing "
    "social related recommended toolbar pagination pager skip search outbrain taboola".split()
)
#: Words that may stand beside those in one name and do not change what it says.
BESIDE = frozenset(
    "area articles aside bar block bottom box buttons col column container content form group holder inner item items left "
    "link links list main outer page panel post posts primary region right secondary section site slot small stories text "
    "thread top unit wrap wrapper zone".split()
)
#: Marks by which the main part of a page is known where no article or main element is.
MAIN = re.compile(r"(?:^|\s)(?:articlebody|(?:article|post|entry|story|main)[_-]?(?:body|content|text))(?:$|\s)")

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({'|'.join(RAW)})\b[^>]*+(?<!/)>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-z][^<>]*\Z",
    re.IGNORECASE | re.DOTALL,
)
#: The same where no > follows any more; the groups of a tag are there and match nothing.
_REST = re.compile(r"(?!)()()()()|<!--.*\Z|<[!?/].*\Z|<[a-z][^<]*\Z", re.IGNORECASE | re.DOTALL)
_NAME = re.compile(r"</?[a-z][^\s/>]*", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"""([a-z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)


@dataclass
class Line:
    """The text of one block: `linked` of its characters are in links; `aside` says it is no main text."""

    text: str
    linked: int
    aside: bool
    main: bool


def _says_aside(name: str) -> bool:
    """Whether a class or id names a use, and nothing but that: "ad-slot" does, "has-sidebar" does not."""
    words = [w for w in re.split(r"[_\-]+|\d+", name) if w]
    return any(w in USE for w in words) and all(w in USE or w in BESIDE for w in words)


def _use(tag: str, attributes: str) -> str:
    """What an element's tag and attributes say: "aside", "main", "header", "named" or nothing.

    "named" is aside by a word in its class or id alone, which holds unless the main part is in it.
    """
    if tag in ASIDE:
        return "aside"
    named = {}
    if attributes.strip(" /"):
        named = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
        marks = " ".join(named.get(k, "") for k in ("class", "id", "itemprop")).lower()
        role = named.get("role", "").lower()
        if role in ROLES or "hidden" in named or named.get("aria-hidden") == "true":
            return "aside"
        if re.search(r"display\s*:\s*none", named.get("style", "")):
            return "aside"
        if role in ("main", "article") or MAIN.search(marks):
            return "main"
        if tag not in ("html", "body", "main", "article", "a") and any(map(_says_aside, marks.split())):
            return "named"
    return "main" if tag in ("article", "main") else "header" if tag == "header" else ""


def _tag_ends(page: str) -> tuple[list[int], list[bool]]:
    """Positions of quotes and of >, and whether a tag that goes on to such a place has an end.

    A quote without a partner is an ordinary character.
    """
    marks = [(m.start(), m[0]) for m in re.finditer("[>\"']", page)]
    ended = [False] * (len(marks) + 1)
    after: dict[str, int] = {}
    for k in range(len(marks) - 1, -1, -1):
        mark = marks[k][1]
        ended[k] = mark == ">" or ended[after[mark] + 1 if mark in after else k + 1]
        after[mark] = k
    return [at for at, _ in marks], ended


def _markup(page: str) -> Iterator[re.Match]:
    """All markup of a page, in time proportional to it, also where tags or quotes are not closed."""
    at, last = page.find("<"), page.rfind(">")
    places = ended = None
    while at >= 0:
        name = _NAME.match(page, at) if places is not None and at < last else None
        hopeless = name and not ended[bisect_left(places, name.end())] and name[0][1:].lower() not in RAW
        m = None if hopeless else (_MARKUP if at < last else _REST).match(page, at)
        if m:
            yield m
        elif places is None:
            places, ended = _tag_ends(page)
        at = page.find("<", m.end() if m else at + 1)


def _matches(tags: list[tuple[int, bool, str]]) -> dict[int, int]:
    """For each opened element that is closed, the position of its end among `tags`."""
    opened: dict[str, list[int]] = {}
    ends = {}
    for i, (_, closing, tag) in enumerate(tags):
        if not closing:
            if tag not in VOID:
                opened.setdefault(tag, []).append(i)
        elif opened.get(tag):
            ends[opened[tag].pop()] = i
    return ends


def lines(page: str) -> list[Line]:
    """Strip the markup of a page to lines of text in page order, without empty ones."""
    tags, attributes, texts, at = [], [], [], 0
    for m in _markup(page):
        texts.append(page[at : m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        tags.append((len(texts), bool(m[2]), tag))
        attributes.append(m[4] or "")
    texts.append(page[at:])
    ends = _matches(tags)
    uses = [
        _use(tag, attributes[i]) if tag and not closing and tag not in VOID and (attributes[i] or tag not in PLAIN) else ""
        for i, (_, closing, tag) in enumerate(tags)
    ]
    mains = [i for i, use in enumerate(uses) if use == "main"]
    for i, use in enumerate(uses):
        if use == "named":
            inside = bisect_left(mains, i)
            uses[i] = "" if inside < len(mains) and mains[inside] < ends.get(i, -1) else "aside"
    out: list[Line] = []
    parts: list[str] = []
    linked = 0
    aside_end = main_end = link_end = header_end = -1

    def flush():
        nonlocal parts, linked
        text = " ".join("".join(parts).split())
        if text:
            out.append(Line(text, min(linked, len(text)), aside_now, main_now))
        parts, linked = [], 0

    aside_now = main_now = False
    for i, text in enumerate(texts):
        if text:
            text = html.unescape(text)
            parts.append(text)
            if i <= link_end:
                linked += len(text.strip())
        if i == len(tags):
            break
        _, closing, tag = tags[i]
        if tag in BLOCKS:
            flush()
        elif tag in SPACED:
            parts.append(" ")
        if not closing and tag and tag not in VOID:
            end = ends.get(i, -1)
            if tag == "a":
                link_end = max(link_end, end)
            use = uses[i]
            if use == "aside" and end > aside_end:
                flush()
                aside_end = end
            elif use == "main" and end < 0 and i > aside_end:
                main_end = len(tags)  # a page that was cut off
            elif use == "main" and i > aside_end:
                main_end = max(main_end, end)
            elif use == "header":
                header_end = max(header_end, end)
        if i in (aside_end, main_end, header_end):
            flush()
        # The title of an article stays, though it is in the article's own header.
        in_header = i < header_end and not (i < main_end and tag in ("h1", "h2"))
        aside_now, main_now = i < aside_end or in_header, i < main_end
    flush()
    return out


def spans(weights: list[int], window: int = WINDOW, surge: int = SURGE) -> Iterator[tuple[int, int]]:
    """Runs of lines between a surge of the window sums and the next dive to nothing, ends trimmed."""
    sums = [sum(weights[i : i + window]) for i in range(len(weights))]
    start = -1
    for i, total in enumerate([*sums, 0]):
        if start < 0 and total >= surge:
            start = i
        elif start >= 0 and total == 0:
            run = [j for j in range(start, i) if weights[j]]
            # A surge is seen at the first window that holds it, which may begin with lines of no weight.
            yield run[0], run[-1] + 1
            start = -1


def weights(found: list[Line]) -> list[int]:
    """What each line weighs: its text outside links, if that is the greater part of it.

    In a marked article or main part all text counts and a line surges by itself; outside of it only what
    a line has beyond OUTSIDE characters counts.
    """
    marked = any(x.main and not x.aside for x in found)
    out = []
    for x in found:
        own = len(x.text) - x.linked if 2 * x.linked <= len(x.text) else 0
        if x.aside:
            out.append(0)
        elif x.main:
            out.append(SURGE + len(x.text))
        else:
            out.append(max(0, own - OUTSIDE) if marked else own)
    return out


def main_text(page: str, window: int = WINDOW, surge: int = SURGE) -> str:
    """The main text of a page, one line per block; empty if there is none."""
    found = lines(page)
    weigh = weights(found)
    fullest = max((sum(weigh[i : i + window]) for i in range(len(weigh))), default=0)
    surge = max(1, min(surge, fullest // SHARE))
    return "\n".join(found[i].text for a, b in spans(weigh, window, surge) for i in range(a, b) if weigh[i])


def extract(df: DataFrame, page: str = "html") -> DataFrame:
    """Replace the column `page` by text and n_chars, the code points of text.

    Null and empty pages, and pages without main text, have an empty text. Every row has its own
    result; other columns stay, but for those with the names of the results.
    """

    def make():
        def one(page: str) -> tuple[str, int]:
            text = main_text(page)
            return text, len(text)

        return one

    return map_text(df, page, make, {"text": pa.string(), "n_chars": pa.int64()})
