"""Periodic runs of words, found by string synchronising sets.

A run is a stretch of words with smallest period q (words q apart are identical) that no neighbour extends
and that holds at least EXPONENT periods and LEAST words. Periods are looked for at dyadic scales; scale t
is for periods of t to 2 t - 1 words.

* Synchronising positions: i is one if the smallest hash among the contexts of t words that begin at i to
  i + t is that of the first or of the last. The choice depends on the 2 t words from i on alone, so equal
  passages are synchronised at equal places. Contexts within a run of a period up to t / 4 take no part,
  which keeps the set sparse; any 3 t - 1 words without so small a period still hold a position.
* A run of period q has a position i within its first t words and the same 2 t words at i + q, for which
  its four periods suffice, and not between, since 2 t > q. So each position and the next one with its
  context propose their distance as a period; the stretch around them is then measured on the words.
* The highly periodic regions left out at a scale are those of smaller scales, which are done by then.
  Periods below DIRECT are found by comparing words at that distance.

All texts of a batch are worked on at once; a word between them that occurs once keeps them apart. Each
text is handled in one place, without a shuffle, in memory proportional to the batch or its longest text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from skyledger.llm.common import mix
from skyledger.llm.syncmers import sliding_min

EXPONENT, LEAST = 4, 6
#: Periods below this are found by comparing words at that distance; also the first scale.
DIRECT = 8
#: Characters of text that are worked on at once; a longer text is worked on alone.
SLICE = 2_000_000
_A, _NONE = np.uint64(0x9E3779B97F4A7C15), np.uint64(2**64 - 1)
RUNS = ArrayType(StructType([StructField(n, LongType()) for n in ("start", "length", "period")]))

Rewrite = Callable[[int | None, int], tuple[int, int] | None]


def stretches(words: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the maximal stretches in which words `q` apart are equal, long enough to be runs."""
    if len(words) <= q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.diff((words[q:] == words[:-q]).view(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + q
    enough = end - start >= max(LEAST, EXPONENT * q)
    return start[enough], end[enough]


def stretch_at(words: np.ndarray, i: int, q: int) -> tuple[int, int]:
    """Bounds of the stretch around word i, given that the word q on equals it; steps double."""
    low, high, n = i, i, len(words) - q
    step = 32
    while high < n:
        differs = words[high : high + step][: n - high] != words[high + q : high + q + step]
        if differs.any():
            high += int(differs.argmax())
            break
        high += len(differs)
        step *= 2
    step = 32
    while low > 0:
        at = max(0, low - step)
        differs = words[at:low] != words[at + q : low + q]
        if differs.any():
            low -= int(differs[::-1].argmax())
            break
        low, step = at, step * 2
    return low, high + q


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether each of `n` positions lies in any of the half-open spans."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, end, -1)
    return np.cumsum(change[:-1]) > 0


def proposals(contexts: np.ndarray, doubles: np.ndarray, t: int, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Synchronising positions of scale t whose context comes again t to 2 t - 1 words on, and how far on.

    `contexts` and `doubles` are the hashes of the t and 2 t words from each position, `runs` the rows
    (start, end, period) found at smaller scales.
    """
    periodic = runs[(runs[:, 2] * 4 <= t) & (runs[:, 1] - runs[:, 0] >= t)]
    ranked = np.where(covered(len(contexts), periodic[:, 0], periodic[:, 1] - t + 1), _NONE, contexts)
    least = sliding_min(ranked, t + 1)
    n = len(least)
    at = np.flatnonzero((least != _NONE) & ((least == ranked[:n]) | (least == ranked[t : t + n])))
    order = np.argsort(doubles[at], kind="stable")
    at = at[order]
    apart = np.diff(at)
    again = (doubles[at[1:]] == doubles[at[:-1]]) & (apart >= t) & (apart < 2 * t)
    return at[:-1][again], apart[again]


def runs_of(words: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, end, period) of all runs of a sequence of word numbers, by start and then period.

    No run is longer than `longest`. The same stretch is listed with its smallest period alone: a stretch
    of at least four periods that has a smaller one too has it on exactly the same bounds.
    """
    found = [np.zeros((0, 3), np.int64)]
    for q in range(1, min(DIRECT, longest // EXPONENT + 1)):
        start, end = stretches(words, q)
        found.append(np.stack([start, end, np.full(len(start), q)], 1))
    contexts, t = mix(words.astype(np.uint64) + _A), 1
    while EXPONENT * t <= longest and len(contexts) > t:
        doubles = mix(contexts[:-t] * _A + contexts[t:])
        if t >= DIRECT:
            last = (0, 0)
            rows = []
            at, apart = proposals(contexts, doubles, t, np.concatenate(found))
            order = np.lexsort((at, apart))
            for i, q in zip(at[order].tolist(), apart[order].tolist()):
                if q == last[0] and i + q < last[1]:
                    continue
                low, high = stretch_at(words, i, q)
                last = (q, high)
                if high - low >= max(LEAST, EXPONENT * q):
                    rows.append((low, high, q))
            if rows:
                found.append(np.array(rows, np.int64))
        contexts, t = doubles, 2 * t
    every = np.concatenate(found)
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    smallest = np.ones(len(every), bool)
    smallest[1:] = (every[1:, :2] != every[:-1, :2]).any(1)
    every = every[smallest]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    low = size = 0
    for i, text in enumerate(texts):
        if i > low and size + len(text) > SLICE:
            yield low, i
            low, size = i, 0
        size += len(text)
    if low < len(texts):
        yield low, len(texts)


def _measure(texts: list[str], ids: list, rewrite: Rewrite | None) -> list[pa.Array]:
    """n_words, runs and collapsed of each text."""
    split = [t.encode().split() for t in texts]
    n = np.array([len(w) for w in split], np.int64)
    first = np.cumsum(n) - n
    coded = pa.array(chain.from_iterable(split), pa.binary()).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    for row in range(len(texts)) if rewrite else ():
        change = rewrite(ids[row], int(n[row]))
        if change:
            (a, p), low, high = change, first[row], first[row] + n[row]
            codes[low + a : high] = codes[low + a + np.arange(n[row] - a) % p]
    row = np.repeat(np.arange(len(texts)), n)
    at = np.arange(len(codes)) + row
    words = np.empty(len(codes) + len(texts), np.int64)
    words[at] = codes
    words[first + n + np.arange(len(texts))] = -1 - np.arange(len(texts))
    found = runs_of(words, int(n.max(initial=0)))
    base = first + np.arange(len(texts))
    owner = np.searchsorted(base, found[:, 0], "right") - 1
    dropped = covered(len(words), found[:, 0] + found[:, 2], found[:, 1])[at]
    kept = pa.array(codes[~dropped], pa.int32())
    ends = np.concatenate([[0], np.cumsum(np.bincount(row[~dropped], minlength=len(texts)))]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), pc.take(coded.dictionary, kept))
    edges = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
    columns = [found[:, 0] - base[owner], found[:, 1] - found[:, 0], found[:, 2]]
    spans = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], ["start", "length", "period"])
    joined = pc.binary_join(lists, b" ").cast(pa.string())
    return [pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(edges), spans), joined]


def find_runs(docs: DataFrame, text: str = "text", rewrite: Rewrite | None = None, key: str = "doc_id") -> DataFrame:
    """Replace `text` by n_words, the `runs` of its words, and `collapsed`.

    Words are what ASCII white space parts; null counts as empty. `runs` are structs of the first word's
    number, the number of words and the period, by start and then period; n words have no more than n runs.
    `collapsed` joins by one space the words that no run has after its first period. `rewrite` gets the key
    and number of words of a row and may return (a, p): words from a on are then first replaced by the p
    words from a, again and again. Empty and blank texts have no runs and are collapsed to "". Every row,
    also a repeated one or one with a null key, has its result; other columns stay, but for those that have
    the name of a result.
    """
    made = ["n_words", "runs", "collapsed"]
    kept = [f for f in docs.schema.fields if f.name != text and f.name not in made]
    names = [f.name for f in kept]
    fields = [StructField(n, t) for n, t in zip(made, (LongType(), RUNS, StringType()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(len(names)).to_pylist()]
            ids = batch.column(len(names) + 1).to_pylist()
            for low, high in _slices(texts):
                part = batch.slice(low, high - low)
                columns = [part.column(i) for i in range(len(names))]
                columns += _measure(texts[low:high], ids[low:high], rewrite)
                yield pa.RecordBatch.from_arrays(columns, names + made)

    columns = [F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)]
    sent = docs.select(*columns, F.col(f"`{text}`").alias("text"), F.col(f"`{key}`").alias("key"))
    return sent.mapInArrow(run, StructType(kept + fields))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, the number of runs, the longest one, and digests of all runs and of the collapsed text.

    Of equally long runs the first one counts, then that of the smallest period; without a run the four
    columns of it are null.
    """
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    written = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    out = found.withColumn("_best", best)
    return out.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("_best.col2")).alias("start"),
        F.col("_best.length").alias("length"),
        (-F.col("_best.col3")).alias("period"),
        F.expr("1000 * _best.length div -_best.col3").alias("exponent_milli"),
        F.sha2(F.array_join(written, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
