"""Divergence of the sources of each language, by row accumulation over a term-major index.

A group is a source within a language; its frequency of a term is an integer, 1 + floor(SCALE * (count +
SMOOTH) / (N + SMOOTH * V)), so that a term it lacks still has the group's baseline. The distance of two
groups is the sum of |p - q| over all V kept terms of the language.

* Index. Tasks count terms of what they hold and send one row a group and term. One shuffle by language
  and term then gives the occurrences of each group, of the language, and the number of documents.
* Rows. The index is cut into blocks of terms, more of them for a language with more entries. In a block
  each group scatters its terms through their entries into a dense accumulator over the block's groups:
  an entry adds |p - q| less what the baselines of the two account for. So the work is that of the
  entries which meet, while a block gives only one row for each pair of groups that meet in it.
* Baselines. Where one or both groups lack a term, |p - q| depends on the group's own p and the other's
  baseline b alone. The sum of |p - b| over a group's terms is read off its cumulated histogram of p, for
  each b of its language, and V |b - b'| is added.

All numbers are integers; sums stay below 2^53, as frequencies sum to about SCALE.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import stored

SCALE, SMOOTH = 1_000_000_000, 5
#: Documents of its language that a kept term is in at least, and terms listed for a group.
LEAST_DOCS, TOP = 30, 50
#: Counts that a task holds before it sends them; entries of a block of the index; groups in a list of peers.
FLUSH, BLOCK, PEERS = 400_000, 1 << 14, 1 << 8

#: Bytes of a term: ASCII letters, in lower case, and those of all other code points; the rest parts terms.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def terms(text: str) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return text.encode().translate(_LETTERS).split()


def _sent(held: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, docs) in held.items():
        columns = [pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string())]
        columns += [pa.array(n.keys(), pa.binary()).cast(pa.string()), pa.array(n.values(), pa.int64())]
        columns.append(pa.array([docs[t] for t in n], pa.int64()))
        yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each group's terms, over FLUSH of them at a time."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(n).to_pylist() for n in ("lang", "source", "text"))):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            words = terms(text)
            size -= len(n)
            n.update(words)
            docs.update(set(words))
            size += len(n)
            if size >= FLUSH:
                yield from _sent(held)
                held, size = {}, 0
    yield from _sent(held)


def named(docs: DataFrame) -> DataFrame:
    """Language, source and text of each document, null as ''."""
    return docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def term_index(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Rows (lang, term, source, n, total, head) of the terms in `least_docs` documents of a language.

    `total` counts the language's occurrences; `head` is 1 in one row of each term, else 0.
    """
    counts = named(docs).mapInArrow(count_terms, COUNTS)
    counts = counts.repartition("lang", "term").groupBy("lang", "term", "source")
    counts = counts.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    counts = counts.select(
        "lang", "term", "source", "n",
        F.sum("docs").over(term).alias("docs"),
        F.sum("n").over(term).alias("total"),
        (F.row_number().over(term.orderBy("source")) == 1).cast("bigint").alias("head"),
    )
    return counts.where(F.col("docs") >= least_docs).drop("docs")


def frequency(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (n + SMOOTH * v)), exact for any bigint; null if v is 0."""
    wide = lambda c: c.cast("decimal(19,0)")
    part, whole = wide(count + SMOOTH) * F.lit(SCALE).cast("decimal(10,0)"), wide(n + SMOOTH * v)
    return F.when(v > 0, F.lit(1) + F.call_function("div", part, whole))


def group_sizes(docs: DataFrame, index: DataFrame) -> DataFrame:
    """Rows (lang, source, group_n, v, lang_n, entries, peers, base) of all groups that occur.

    `group_n` and `lang_n` are the kept occurrences of the group and of its language; the language has `v`
    kept terms, `entries` in the index and `peers` groups. `base` is the frequency of a term the group lacks.
    """
    groups = named(docs).select("lang", "source").distinct()
    sums = index.groupBy("lang", "source").agg(
        F.sum("n").alias("group_n"), F.sum("head").alias("heads"), F.count("*").alias("rows")
    )
    groups = groups.join(sums, ["lang", "source"], "left").na.fill(0, ["group_n", "heads", "rows"])
    langs = groups.groupBy("lang").agg(
        F.sum("heads").alias("v"),
        F.sum("group_n").alias("lang_n"),
        F.sum("rows").alias("entries"),
        F.count("*").alias("peers"),
    )
    out = groups.drop("heads", "rows").join(langs, "lang")
    return out.withColumn("base", frequency(F.lit(0).cast("bigint"), F.col("group_n"), F.col("v")))


def _coded(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct strings of a column in order, and the number of each row's string."""
    found = column.combine_chunks().dictionary_encode()
    names, place = np.unique(found.dictionary.to_numpy(zero_copy_only=False), return_inverse=True)
    return names, place[found.indices.to_numpy()]


def scattered(entries: pa.Table) -> pa.Table:
    """Pairs of groups that meet in a block of the index, with the sum of their corrections.

    For each term both have, that is |p - q| - |p - b'| - |q - b| + |b - b'| for frequencies p and q and
    baselines b and b'. Each pair is given once, the smaller group first.
    """
    names, group = _coded(entries.column("source"))
    _, term = _coded(entries.column("term"))
    p, base = (entries.column(c).to_numpy() for c in ("p", "base"))
    # By term, and within a term by group; a group's terms are then looked up in another order.
    order = np.lexsort((group, term))
    group, term, p, base = group[order], term[order], p[order], base[order]
    edges = np.searchsorted(term, np.arange(term.max() + 2))
    mine = np.argsort(group, kind="stable")
    rows = np.searchsorted(group[mine], np.arange(len(names) + 1))
    lo, hi, total = [], [], []
    for g in range(len(names)):
        at = mine[rows[g] : rows[g + 1]]
        # The entries of the same terms that come behind: those of larger groups.
        n = edges[term[at] + 1] - at - 1
        met = np.repeat(at + 1, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        own, b = np.repeat(p[at], n), base[at[0]]
        fix = np.abs(own - p[met]) - np.abs(own - base[met]) - np.abs(p[met] - b) + np.abs(base[met] - b)
        peers = len(names) - g - 1
        sums = np.zeros(peers, np.int64)
        np.add.at(sums, group[met] - g - 1, fix)
        present = np.flatnonzero(sums)
        lo.append(np.full(len(present), g))
        hi.append(present + g + 1)
        total.append(sums[present])
    lo, hi, total = (np.concatenate(x) for x in (lo, hi, total))
    lang = pa.array([entries.column("lang")[0].as_py()] * len(lo), pa.string())
    columns = [lang, pa.array(names[lo], pa.string()), pa.array(names[hi], pa.string()), pa.array(total, pa.int64())]
    return pa.Table.from_arrays(columns, ["lang", "lo", "hi", "value"])


def against_baselines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For a group and each peer of a list: sum of |p - b'| - |b - b'| over the group's terms, and half of
    V |b - b'|, which the peer's own row completes: it is added where the peer is the larger one."""
    for batch in batches:
        for row in batch.to_pylist():
            peers = np.array(row["peers"], object)
            other = np.array(row["bases"], np.int64)
            part = peers != row["source"]
            peers, other = peers[part], other[part]
            if not len(peers):
                continue
            larger = np.array([x.encode() > row["source"].encode() for x in peers], bool)
            gap = np.abs(other - (row["base"] or 0))
            p, n = np.array(row["ps"] or [], np.int64), np.array(row["ns"] or [], np.int64)
            order = np.argsort(p)
            p, n = p[order], n[order]
            count, total = (np.concatenate([[0], np.cumsum(x)]) for x in (n, n * p))
            at = np.searchsorted(p, other)
            sums = other * count[at] - total[at] + (total[-1] - total[at]) - other * (count[-1] - count[at])
            value = sums - gap * count[-1] + np.where(larger, gap * row["v"], 0)
            own = np.array([row["source"]] * len(peers), object)
            columns = [pa.array([row["lang"]] * len(peers), pa.string())]
            columns += [pa.array(np.where(larger, own, peers), pa.string()), pa.array(np.where(larger, peers, own), pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(value, pa.int64())], ["lang", "lo", "hi", "value"])


def pair_distances(index: DataFrame, groups: DataFrame, block: int = BLOCK) -> DataFrame:
    """(lang, lo, hi, value) of each pair of groups of a language; lo < hi as UTF-8.

    `index` has the frequencies `p` of its groups and their baselines.
    """
    blocks = (F.col("entries") / block).cast("bigint") + 1
    entries = index.withColumn("block", F.pmod(F.xxhash64("term"), blocks))
    met = entries.select("lang", "block", "term", "source", "p", "base").groupBy("lang", "block")
    schema = "lang string, lo string, hi string, value bigint"
    met = met.applyInArrow(scattered, schema)
    levels = index.groupBy("lang", "source", "p").agg(F.count("*").alias("n")).groupBy("lang", "source")
    levels = levels.agg(F.collect_list(F.struct("p", "n")).alias("levels"))
    levels = levels.select("lang", "source", F.col("levels.p").alias("ps"), F.col("levels.n").alias("ns"))
    lists = F.pmod(F.xxhash64("source"), (F.col("peers") / PEERS).cast("bigint") + 1)
    peers = groups.select("lang", "source", F.coalesce("base", F.lit(0)).alias("base"), lists.alias("list"))
    peers = peers.groupBy("lang", "list").agg(F.collect_list(F.struct("source", "base")).alias("peers"))
    peers = peers.select("lang", F.col("peers.source").alias("peers"), F.col("peers.base").alias("bases"))
    own = groups.select("lang", "source", "base", "v").join(levels, ["lang", "source"], "left").join(peers, "lang")
    own = own.select("lang", "source", "base", "v", "ps", "ns", "peers", "bases").mapInArrow(against_baselines, schema)
    return own.union(met).groupBy("lang", "lo", "hi").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank): how the sources of each language differ.

    Part `pair`: each other source of the language with its distance. Part `term`: the terms that a group
    has more often than its language, with the difference of the two frequencies, down to rank `top`.
    Ranks count from 1 for each group and part, the largest value first and equal ones by item. Null lang,
    source and text are ''. A language without kept terms has distances of 0, a group alone in its language
    has no pairs; repeated rows are documents of their own; no rows give none. Other columns play no part.
    """
    index = stored(term_index(docs, least_docs), "term_index")
    groups = stored(group_sizes(docs, index), "groups")
    known = index.join(groups.drop("peers"), ["lang", "source"])
    p, q = (frequency(F.col(c), F.col(n), F.col("v")) for c, n in (("n", "group_n"), ("total", "lang_n")))
    known = known.select("lang", "source", "term", "base", "entries", p.alias("p"), q.alias("q"))
    more = known.where(F.col("p") > F.col("q"))
    more = more.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    way = lambda a, b: F.struct(F.col(a).alias("source"), F.col(b).alias("item"))
    ways = F.explode(F.array(way("lo", "hi"), way("hi", "lo")))
    pairs = pair_distances(known, groups, block).select("lang", "value", ways.alias("way"))
    pairs = pairs.select("lang", "way.source", "way.item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    return ranked(pairs, "pair").union(ranked(more, "term").where(F.col("rank") <= top))
