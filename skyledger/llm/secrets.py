"""Secret scans: keywords are found by one automaton, expressions are tried only where a keyword starts.

A detector whose tokens carry a checksum validates it, so a random string of the right form is no hit.
Runs of hexadecimal digits have no keyword and are searched directly.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import map_text

BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc_base62(body: str) -> str:
    """CRC-32 of the text in six digits to the base 62, the checksum some tokens end with."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


def _crc_ok(m: re.Match) -> bool:
    return crc_base62(m[1][:-6]) == m[1][-6:]


def _jwt_ok(m: re.Match) -> bool:
    head = m[0].split(".")[0]
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, TypeError):
        return False


@dataclass(frozen=True)
class Detector:
    """`keywords` in lower case, one of which starts every match; `secret` is the group to mask.

    `run`: where no match starts at a keyword, none starts at a later one in the same run of this either.
    """

    kind: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    valid: Callable[[re.Match], bool] = lambda m: True
    secret: int = 0
    run: re.Pattern | None = None


#: In the order in which spans with one start are listed; the base ones first.
DETECTORS = (
    Detector(
        "assign",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        re.compile(
            r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
        ),
        lambda m: len(m[2]) >= 6,
        secret=2,
    ),
    Detector("access", ("akia",), re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    Detector("hex", (), re.compile("[0-9a-f]{24,}")),
    Detector("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile("gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), _crc_ok),
    Detector("npm", ("npm_",), re.compile("npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), _crc_ok),
    Detector("jwt", ("eyj",), re.compile(r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"), _jwt_ok, run=re.compile("[A-Za-z0-9_-]+")),
    Detector("slack", ("xoxb-", "xoxp-", "xoxa-", "xoxr-", "xoxs-"), re.compile("xox[abprs]-[0-9]{8,}-[0-9A-Za-z-]{16,}")),
    Detector("payment", ("sk_live_", "rk_live_"), re.compile("[sr]k_live_[0-9A-Za-z]{24,}")),
    Detector("pem", ("-----begin ",), re.compile("-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\\s]+-----END [A-Z ]*PRIVATE KEY-----")),
)
ORDER = {d.kind: i for i, d in enumerate(DETECTORS)}
SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
BASE_KINDS = ("assign", "access", "hex")


def scanner() -> Callable[[str], list[tuple[int, int, str, int, int]]]:
    """A function that lists the secrets of a text: start, end, kind, and start and end of the part to mask."""
    words = ahocorasick.Automaton()
    for d in DETECTORS:
        for w in d.keywords:
            words.add_word(w, (len(w), ORDER[d.kind]))
    words.make_automaton()
    free = [d for d in DETECTORS if not d.keywords]

    def scan(text: str) -> list[tuple[int, int, str, int, int]]:
        found = []
        for d in free:
            found += [(*m.span(), d.kind, *m.span(d.secret)) for m in d.pattern.finditer(text) if d.valid(m)]
        # Only ASCII letters are lowered, so positions stay.
        lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
        ends = [0] * len(DETECTORS)
        for start, k in sorted((end + 1 - n, k) for end, (n, k) in words.iter(lowered)):
            d = DETECTORS[k]
            if start < ends[k]:
                continue
            if m := d.pattern.match(text, start):
                # As a search from the left would go on behind a match that fails the test of length.
                ends[k] = m.end()
                if d.valid(m):
                    found.append((*m.span(), d.kind, *m.span(d.secret)))
            elif d.run and (same := d.run.match(text, start)):
                ends[k] = same.end()
        return sorted(found, key=lambda s: (s[0], ORDER[s[2]]))

    return scan


def find_secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace `text` by `secrets`, an array of (kind, start, end) in code points, end exclusive.

    Sorted by start, then by kind in the order of DETECTORS. Null and empty texts have an empty
    array, every row has its own; other columns stay.
    """

    def make():
        scan = scanner()
        return lambda t: ([{"kind": k, "start": a, "end": b} for a, b, k, _, _ in scan(t)],)

    return map_text(df, text, make, {"secrets": SPANS})


def summarise(df: DataFrame) -> DataFrame:
    """Counts and digests of `secrets`; spans are written kind:start:end and joined by commas."""
    written = lambda a: F.array_join(
        F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")

    counts = {f"n_{k}": count(k) for k in BASE_KINDS}
    return df.withColumns({**counts, "base_sha256": F.sha2(written(base), 256), "spans": written("secrets")}).drop("secrets")


def mask(text: str, spans: list[tuple[int, int, str, int, int]], by: str = "[SECRET]") -> str:
    """The text with the secret part of each span replaced; overlapping parts are replaced together."""
    out, at = [], 0
    for low, high in sorted((s[3], s[4]) for s in spans):
        if low >= at:
            out += [text[at:low], by]
        at = max(at, high)
    return "".join(out) + text[at:]


def mask_secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """Every row with the secrets in its text masked; rows and other columns stay, a null text stays null.

    The digits of a checksum are part of the secret. Texts without a secret are unchanged.
    """
    def run(batches):
        scan = scanner()
        for batch in batches:
            at = batch.schema.names.index(text)
            texts = [t if not t or not (s := scan(t)) else mask(t, s) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, text, pa.array(texts, pa.string()))

    return df.mapInArrow(run, df.schema)
