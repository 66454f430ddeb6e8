"""Mixing sources to target weights by balanced sampling with the cube method.

A source's target over its size says how often its documents are taken: all of them the whole part of
that ratio, and a sample of them once more, each with the fractional part as its inclusion probability.
The flight moves these probabilities through the null-space of two constraints, the totals of words and
of documents, three units at a time, until each but two is 0 or 1. It runs in blocks of bounded size; the
two units that a block leaves are gathered and fly again, so a source of any size ends in one block
whose last units, the landing problem, are rounded to come nearest to the totals.
"""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import SPACE, stored
from skyledger.llm.membership import with_membership

WEIGHTS = (5, 2, 1)
BLOCK = 1024
LANDING = 12
CLOSE = 1e-9


def n_words(text: str) -> Column:
    """Words of a text, split at ASCII white space; 0 for null."""
    trimmed = F.trim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, f"{SPACE}+"))).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target and n_units (rows) of each source.

    Weights repeat along the sources by code point, null last; `share` of all sizes is dealt out by
    weight. A target stops at `most` times its source's size and the excess is dealt again. Sources are
    few against documents; their one window holds a row each.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_units"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*map(F.lit, weights)), place % len(weights)).cast("double")
    ranked = sums.withColumn("_w", weight).withColumn("_full", F.col("source_size") * F.lit(most))
    # In order of the level at which they are full, a source is not full once the level for it and all
    # after it, with those before it full, is no higher than its own.
    order = Window.orderBy(F.col("_full") / F.col("_w"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("_full").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing))
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(every) * F.lit(share)
    leveled = ranked.withColumns({"_level": (total - before) / after, "_place": F.row_number().over(order)})
    is_open = F.col("_level") <= F.col("_full") / F.col("_w")
    level = F.min(F.when(is_open, F.struct("_place", "_level"))).over(every)["_level"]
    dealt = F.least(F.coalesce(level * F.col("_w"), F.col("_full")), F.col("_full"))
    return leveled.select("source", "source_size", "n_units", dealt.alias("target"))


def flight(pi: np.ndarray, size: np.ndarray, count: np.ndarray, rng: random.Random, stop: int) -> list[int]:
    """Move `pi` in place until at most max(2, stop) of its values are inside (0, 1); returns their places."""
    p, sizes, counts = pi.tolist(), size.tolist(), count.tolist()
    waiting = [i for i in range(len(p)) if 0 < p[i] < 1][::-1]
    active: list[int] = []
    while len(active) + len(waiting) > max(2, stop):
        while len(active) < 3:
            active.append(waiting.pop())
        (a, b, c), (x, y, z), (k, m, n) = active, (sizes[i] for i in active), (counts[i] for i in active)
        u = (m * z - n * y, n * x - k * z, k * y - m * x)
        top = max(map(abs, u))
        # Units in proportion span one constraint only.
        u, top = (u, top) if top > 0 else ((m, -k, 0), max(m, k))
        u = [v / top for v in u]
        up = min((1 - p[i]) / v if v > 0 else p[i] / -v for i, v in zip(active, u) if v)
        down = min(p[i] / v if v > 0 else (1 - p[i]) / -v for i, v in zip(active, u) if v)
        step = up if rng.random() * (up + down) < down else -down
        for i, v in zip(active, u):
            p[i] += step * v
            p[i] = 0.0 if p[i] < CLOSE else 1.0 if p[i] > 1 - CLOSE else p[i]
        active = [i for i in active if 0 < p[i] < 1]
    pi[:] = p
    return active + waiting[::-1]


def land(pi: np.ndarray, size: np.ndarray, count: np.ndarray, left: list[int]) -> None:
    """Round the last units in place so that words, and next to them documents, come nearest to the totals."""
    ways = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    off = ways - pi[left]
    cost = np.abs(off @ size[left]) + np.abs(off @ count[left]) * (0.1 * size[left].mean() + 1e-6)
    pi[left] = ways[int(cost.argmin())]


def choose(units: DataFrame, seed: str = "mix", block: int = BLOCK) -> DataFrame:
    """Turn `_pi` of each unit (source, size, count, n_units, `_key`) to 0 or 1, source by source.

    The same units give the same sample in any order and partitioning.
    """
    schema = units.withColumn("_blocks", F.lit(1).cast("bigint")).withColumn("_block", F.lit(1).cast("bigint")).schema
    names = schema.names

    def fly(group: pa.Table) -> pa.Table:
        group = group.sort_by([("_key", "ascending"), ("size", "ascending"), ("count", "ascending")])
        size, count = (group.column(n).to_numpy().astype(float) for n in ("size", "count"))
        pi = group.column("_pi").to_numpy().copy()
        source, blocks, at = (group.column(n)[0].as_py() for n in ("source", "_blocks", "_block"))
        rng = random.Random(f"{seed} {source!r} {blocks} {at}")
        left = flight(pi, size, count, rng, LANDING if blocks == 1 else 2)
        if blocks == 1 and left:
            land(pi, size, count, left)
        return group.set_column(names.index("_pi"), "_pi", pa.array(pi)).select(names)

    done, rest = [], units.withColumn("_blocks", F.ceil(F.col("n_units") / block))
    widest = units.agg(F.max("n_units")).first()[0] or 0
    blocks = math.ceil(widest / block)
    while blocks:
        at = F.pmod(F.xxhash64("_key", "_blocks"), F.col("_blocks"))
        flown = stored(rest.withColumn("_block", at).groupBy("source", "_block").applyInArrow(fly, schema), "flight")
        inside = (F.col("_pi") > 0) & (F.col("_pi") < 1)
        done.append(flown.where(~inside))
        rest = flown.where(inside).withColumn("_blocks", F.ceil(F.col("_blocks") * 2 / block))
        blocks = 0 if blocks == 1 else math.ceil(blocks * 2 / block)
    out = done[0] if done else rest.withColumn("_block", F.lit(1))
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("_blocks", "_block")


def plan_mix(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: str = "mix"
) -> DataFrame:
    """doc_id, source, size, source_size, target and copies for each row of (doc_id, source, size).

    Rows that are equal in all three are one unit, taken or left together. A source without words has
    target 0 and no copies; a document without words is taken like the others of its source. An empty
    table gives an empty plan. Null ids and null sources are values like others.
    """
    by_source = stored(targets(sizes, weights, share, most), "targets")
    # Sources come back under another name, since null keys have to meet too.
    named = by_source.withColumnRenamed("source", "_m_source")
    units = sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("_n"))
    units = units.join(named, units["source"].eqNullSafe(named["_m_source"])).drop("_m_source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = units.withColumns({"_base": F.floor(ratio), "_pi": ratio - F.floor(ratio)})
    units = units.withColumns({"_words": F.col("size"), "_key": F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1)))})
    units = units.withColumns({"size": F.col("size") * F.col("_n"), "count": F.col("_n")})
    chosen = choose(units, seed)
    copies = (F.col("_base") + F.col("_pi")).cast("int").alias("copies")
    return chosen.select("doc_id", "source", F.col("_words").alias("size"), "source_size", "target", copies, "_n")


def mix(df: DataFrame, text: str = "text", **how) -> DataFrame:
    """The rows of `df`, each as often as the mix takes it; columns stay as they are.

    Sizes are words of `text`. Uses the columns doc_id and source.
    """
    keys = ["doc_id", "source"]
    sized = df.withColumn("_m_size", n_words(text))
    plan = plan_mix(stored(sized.select(*keys, F.col("_m_size").alias("size")), "sizes"), **how)
    plan = stored(plan.select(*keys, F.col("size").alias("_m_size"), "copies"), "plan")
    # A source's documents are taken a whole number of times or once more; which, is told without moving the texts.
    low = plan.groupBy(F.col("source").alias("_m_source")).agg(F.min("copies").alias("_m_low"))
    low = stored(low, "low")
    named = plan.join(low, plan["source"].eqNullSafe(low["_m_source"]))
    more = named.select(*keys, "_m_size", (F.col("copies") > F.col("_m_low")).alias("_m_more"))
    taken = with_membership(sized, more, [*keys, "_m_size"], "_m_more")
    taken = taken.join(low, taken["source"].eqNullSafe(low["_m_source"]))
    taken = taken.withColumn("_m_copies", F.col("_m_low") + F.col("_m_more").cast("int")).where("_m_copies > 0")
    return taken.withColumn("_m_copy", F.explode(F.sequence(F.lit(1), F.col("_m_copies")))).select(df.columns)
