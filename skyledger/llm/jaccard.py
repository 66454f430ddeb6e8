"""Near-duplicate documents: an exact join of shingle sets at a Jaccard similarity of 0.8 or more.

Sets that are equal become one node first. The counts of a set's shingles in hashed groups, GROUPS or
more, are a point; the overlap of two sets is at most the sum of the smaller coordinates, which bounds whole boxes of
points too. One tree over all points would compare nearly every pair of boxes, as counts of unrelated
texts of one length differ little, so there is a forest: a key's points have a tree of their own. Keys are
a set's rarest shingles, as many as two sets at the threshold cannot all differ in, and decide nothing but
which points meet; rarity comes from a table of counters of fixed size, and any order is right. Pairs that
pass the bound are verified on their texts.

Only components are asked for, so pairs that are known to be connected are passed over: the members of a
key are verified against one of them first; then, tree by tree, each against two that the bound allows; and
then all pairs across the components that are left.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import SLICE_BYTES, byte_slices, mix, stored
from skyledger.llm.graph import components
from skyledger.llm.membership import with_membership

SHINGLE = 5
#: Similarity at least PART / WHOLE.
PART, WHOLE = 80, 100
GROUPS, LEAF = 128, 32
#: Pairs of points, and of boxes, that are compared at once.
COMPARED, BOXES = 4096, 1024
#: Counters of the rarity table: 2 ** COUNTER_BITS, in CHUNKS parts.
COUNTER_BITS, CHUNKS = 21, 64
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, b, np.uint64)])) for b in (_BASE, inverse))
    return up, down


@functools.cache
def _slice_powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers for any slice but a single longer text, made once per process."""
    return _powers(SLICE_BYTES)


def word_hashes(data: np.ndarray, bounds: np.ndarray, powers) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word of the texts, A-Z lowered, and the bounds of the texts among the words."""
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    start = ~space & (edge[:-1] | np.concatenate([[True], space[:-1]]))
    end = ~space & (edge[1:] | np.concatenate([space[1:], [True]]))
    first, last = np.flatnonzero(start), np.flatnonzero(end) + 1
    up, down = powers
    sums = np.concatenate([[np.uint64(0)], np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
    return mix((sums[last] - sums[first]) * down[first]), np.searchsorted(first, bounds)


def shingle_sets(column: pa.Array, width: int = SHINGLE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole rows: the first row, the sets' hashes row by row in ascending order, and their bounds.

    A text with fewer words than `width` has one shingle of all of them; a text without words has none.
    """
    for low, data, bounds in byte_slices(column):
        words, at = word_hashes(data, bounds, _slice_powers() if len(data) <= SLICE_BYTES else _powers(len(data)))
        rows = len(bounds) - 1
        counts = np.diff(at)
        joined = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for k in range(width):
            joined = joined * _BASE + words[k : k + len(joined)]
        owner = np.repeat(np.arange(rows), counts)
        inside = owner[: len(joined)] == owner[width - 1 :] if len(joined) else np.zeros(0, bool)
        short = np.flatnonzero((counts > 0) & (counts < width))
        whole = np.zeros(len(short), np.uint64)
        for i, r in enumerate(short):
            for k in range(at[r], at[r + 1]):
                whole[i : i + 1] = whole[i : i + 1] * _BASE + words[k]
        hashes = mix(np.concatenate([joined[inside], whole + counts[short].astype(np.uint64)]))
        owner = np.concatenate([owner[: len(joined)][inside], short])
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        yield low, hashes[new], np.searchsorted(owner[new], np.arange(rows + 1))


def _sum_by(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """128 bits that equal sets share, whatever the order; empty for an empty set."""
    a, b = _sum_by(mix(hashes), bounds), _sum_by(mix(~hashes), bounds)
    both = np.stack([a, b], 1).astype("<u8").tobytes()
    return [both[16 * i : 16 * i + 16] if bounds[i + 1] > bounds[i] else b"" for i in range(len(bounds) - 1)]


def nodes_of(sigs: list[bytes]) -> np.ndarray:
    """The node of each signature: its first half; 0 for an empty set, which is no node."""
    return np.frombuffer(b"".join(s[:8] or bytes(8) for s in sigs), "<i8")


def points(hashes: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Counts of each set's shingles in hashed groups, a byte each.

    There are GROUPS groups, or the power of two from a quarter of the set's size on, so that counts of
    unrelated sets differ enough at any size; more where a count would not fit a byte.
    """
    out = []
    for low, high in zip(bounds[:-1], bounds[1:]):
        n = max(GROUPS, 1 << max(0, int(high - low - 1) // 4).bit_length())
        while (held := np.bincount((hashes[low:high] % np.uint64(n)).astype(np.int64), minlength=n)).max() > 255:
            n *= 2
        out.append(held.astype(np.uint8).tobytes())
    return out


def folded(point: bytes, n: int) -> np.ndarray:
    """The counts of a point in `n` groups, which divide its own."""
    return np.frombuffer(point, np.uint8).reshape(-1, n).sum(0, dtype=np.int32)


def profile(docs: DataFrame) -> DataFrame:
    """Of each row of (doc_id, text): n, sig and point, with t and n_chars that tell its text; and the counters.

    Rows of the counters have a chunk and its values, compressed, in `point`, and no sig. They count each set once per
    task.
    """

    def run(batches):
        counters, seen = np.zeros(1 << COUNTER_BITS, np.uint32), set()
        for batch in batches:
            for low, hashes, bounds in shingle_sets(batch.column("text")):
                sigs, n = signatures(hashes, bounds), np.diff(bounds)
                fresh = np.array([s not in seen and not seen.add(s) for s in sigs], bool)
                counted = hashes[np.repeat(fresh, n)] >> np.uint64(64 - COUNTER_BITS)
                np.add.at(counters, counted.astype(int), 1)
                part = batch.slice(low, len(n))
                yield rows(part, n, sigs, points(hashes, bounds))
        parts = counters.reshape(CHUNKS, -1)
        if seen:
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": [None] * CHUNKS, "t": [None] * CHUNKS, "n_chars": [None] * CHUNKS, "n": [0] * CHUNKS,
                    "sig": [None] * CHUNKS, "node": [None] * CHUNKS, "point": [zlib.compress(p.tobytes(), 1) for p in parts], "chunk": list(range(CHUNKS)),
                },
                kinds,
            )

    kinds = pa.schema(
        [("doc_id", pa.int64()), ("t", pa.int64()), ("n_chars", pa.int32()), ("n", pa.int64()), ("sig", pa.binary()),
         ("node", pa.int64()), ("point", pa.binary()), ("chunk", pa.int32())]
    )

    def rows(part, n, sigs, held):
        columns = [part.column("doc_id"), part.column("t"), part.column("n_chars"), pa.array(n, pa.int64())]
        columns += [pa.array(sigs, pa.binary()), pa.array(nodes_of(sigs)), pa.array(held, pa.binary()), pa.nulls(len(n), pa.int32())]
        return pa.RecordBatch.from_arrays(columns, schema=kinds)

    schema = "doc_id bigint, t bigint, n_chars int, n bigint, sig binary, node bigint, point binary, chunk int"
    return with_text_key(docs).mapInArrow(run, schema)


def with_text_key(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text")).withColumns({"t": F.xxhash64("text"), "n_chars": F.length("text")})


def rarity(profiled: DataFrame) -> np.ndarray:
    """A class for each counter: 0 up to four times the mean, one more for each doubling. Of fixed size."""

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros((1 << COUNTER_BITS) // CHUNKS, np.uint64)
        for value in group.column("point"):
            total += np.frombuffer(zlib.decompress(value.as_buffer()), np.uint32)
        return pa.table({"chunk": group.column("chunk")[:1], "total": pa.array([total.tobytes()], pa.binary())})

    parts = profiled.where("chunk IS NOT NULL").select("chunk", "point").groupBy("chunk")
    found = {r.chunk: np.frombuffer(r.total, np.uint64) for r in parts.applyInArrow(add, "chunk int, total binary").collect()}
    if not found:
        return np.zeros(1 << COUNTER_BITS, np.uint8)
    total = np.concatenate([found[c] for c in range(CHUNKS)])
    return np.ceil(np.log2(np.maximum(1, total / (4 * max(total.mean(), 8))))).astype(np.uint8)


def keys(hashes: np.ndarray, bounds: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and key of each set's rarest shingles: |S| - ceil(0.8 |S|) + 1 of them.

    In one order of all shingles, two sets at the threshold share one of these.
    """
    n = np.diff(bounds)
    owner = np.repeat(np.arange(len(n)), n)
    rank = classes[(hashes >> np.uint64(64 - COUNTER_BITS)).astype(int)]
    order = np.lexsort((hashes, rank, owner))
    place = np.arange(len(hashes)) - np.repeat(bounds[:-1], n)
    first = place < np.repeat(n + (-PART * n) // WHOLE + 1, n)
    return owner[first], hashes[order][first]


def key_lists(docs: DataFrame, classes: np.ndarray, buckets: int) -> DataFrame:
    """(members, shared): each set of two or more nodes that have a key in common, and how many keys in a bucket.

    Tasks send a block of (key, node) to each bucket of keys; a set that a task has seen is not sent again.
    """
    held = docs.sparkSession.sparkContext.broadcast(classes)

    def send(batches):
        seen: set[bytes] = set()
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for _, hashes, bounds in shingle_sets(batch.column("text")):
                sigs = signatures(hashes, bounds)
                fresh = np.array([bool(s) and s not in seen and not seen.add(s) for s in sigs], bool)
                nodes = nodes_of(sigs)
                owner, key = keys(hashes, bounds, held.value)
                sent = fresh[owner]
                parts.append((key[sent], nodes[owner[sent]]))
                size += int(sent.sum())
                if size > 4_000_000:
                    yield from blocks(parts)
                    parts, size = [], 0
        yield from blocks(parts)

    def blocks(parts):
        if not parts:
            return
        key, node = (np.concatenate(x) for x in zip(*parts))
        bucket = ((key >> np.uint64(8)) % np.uint64(buckets)).astype(np.int32)
        order = np.lexsort((node, bucket))
        key, node, bucket = key[order], node[order], bucket[order]
        edges = np.searchsorted(bucket, np.arange(buckets + 1))
        for b in range(buckets):
            at = slice(edges[b], edges[b + 1])
            if edges[b] < edges[b + 1]:
                row = {"bucket": [b], "keys": [key[at].tobytes()], "nodes": [node[at].tobytes()]}
                yield pa.RecordBatch.from_pydict(row, pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("nodes", pa.binary())]))

    def meet(group: pa.Table) -> pa.Table:
        key = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("keys")])
        node = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in group.column("nodes")])
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        key, node = key[new], node[new]
        edges = np.append(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])), len(key))
        lists: dict[bytes, int] = {}
        for i in np.flatnonzero(np.diff(edges) > 1):
            members = node[edges[i] : edges[i + 1]].tobytes()
            lists[members] = lists.get(members, 0) + 1
        return pa.table({"members": pa.array(list(lists), pa.binary()), "shared": pa.array(list(lists.values()), pa.int64())})

    sent = docs.select("text").mapInArrow(send, "bucket int, keys binary, nodes binary")
    return sent.groupBy("bucket").applyInArrow(meet, "members binary, shared bigint")


def may_link(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether the overlap of two points may reach the threshold, by the sum of the smaller coordinates."""
    most = np.minimum(p, q).sum(-1, dtype=np.int64)
    return WHOLE * most >= PART * (p.sum(-1, dtype=np.int64) + q.sum(-1, dtype=np.int64) - most)


def finer(held: list[bytes], x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs (x, y) of points those that may link by as many groups as both points have, and their bounds."""
    size = np.array([len(p) for p in held])
    least = np.minimum(size[x], size[y])
    most, total = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for n in np.unique(least):
        rows = np.flatnonzero(least == n)
        step = max(1, (1 << 22) // n)
        for k in range(0, len(rows), step):
            part = rows[k : k + step]
            own, at = np.unique(np.concatenate([x[part], y[part]]), return_inverse=True)
            points = np.stack([folded(held[i], n) for i in own])
            p, q = at[: len(part)], at[len(part) :]
            most[part] = np.minimum(points[p], points[q]).sum(-1)
            total[part] = points.sum(-1)[p] + points.sum(-1)[q]
    passed = WHOLE * most >= PART * (total - most)
    return x[passed], y[passed], most[passed] / np.maximum(1, total - most)[passed]


class Nearest:
    """Of each of `n` nodes the first partner, by number, among lower nodes, and the partner of the highest bound."""

    def __init__(self, n: int):
        self.first, self.best, self.bound, self.count = np.full(n, n), np.full(n, n), np.zeros(n), 0

    def add(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> None:
        self.count += len(low)
        np.minimum.at(self.first, high, low)
        end, other = np.concatenate([low, high]), np.concatenate([high, low])
        bound = np.concatenate([bound, bound])
        order = np.lexsort((other, -bound, end))
        end, other, bound = end[order], other[order], bound[order]
        top = np.ones(len(end), bool)
        top[1:] = end[1:] != end[:-1]
        end, other, bound = end[top], other[top], bound[top]
        better = (bound > self.bound[end]) | ((bound == self.bound[end]) & (other < self.best[end]))
        self.best[end[better]], self.bound[end[better]] = other[better], bound[better]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.first)
        node = np.arange(n)
        both = np.stack([np.concatenate([self.first, np.minimum(self.best, node)]), np.concatenate([node, np.maximum(self.best, node)])])
        low, high = np.unique(both[:, (both < n).all(0)], axis=1)
        return low, high


class Tree:
    """A packed R-tree: points sorted by size and then by coordinates, in leaves of LEAF, boxes over boxes."""

    def __init__(self, held: np.ndarray):
        spread = np.argsort(-held.var(0))[:3]
        self.order = np.lexsort((*held[:, spread].T, held.sum(1)))
        self.points = held[self.order]
        self.levels = []
        low, high, small = self.points, self.points, self.points.sum(1, dtype=np.int64)
        while not self.levels or len(high) > 1:
            starts = np.arange(0, len(high), LEAF)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            small = np.minimum.reduceat(small, starts)
            self.levels.append((high, small))

    def boxes_may_link(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The overlap of any points of two boxes is at most that of their upper corners."""
        high, small = self.levels[level]
        most = np.minimum(high[a], high[b]).sum(-1, dtype=np.int64)
        # |A & B| >= PART / (PART + WHOLE) * (|A| + |B|), and no set is smaller than the smallest of its box.
        return (PART + WHOLE) * most >= PART * (small[a] + small[b])

    def points_may_link(self, c: np.ndarray, d: np.ndarray) -> np.ndarray:
        """`may_link` of points by place; few are copied at once, so memory does not follow the number of pairs."""
        linked = np.zeros(len(c), bool)
        for k in range(0, len(c), COMPARED):
            part = slice(k, k + COMPARED)
            linked[part] = may_link(self.points[c[part]], self.points[d[part]])
        return linked

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions of points of the input that may link, each pair once, in pieces."""
        stack = [(len(self.levels) - 1, np.array([0]), np.array([0]))]
        while stack:
            level, x, y = stack.pop()
            if len(x) > BOXES:
                # The rest waits until all below these pairs is done, so that few pairs wait at a time.
                stack.append((level, x[BOXES:], y[BOXES:]))
                x, y = x[:BOXES], y[:BOXES]
            passed = self.boxes_may_link(level, x, y)
            x, y = x[passed], y[passed]
            size = len(self.levels[level - 1][1]) if level else len(self.points)
            for i in range(0, len(x), 64):
                # The children of each pair of boxes, ordered so that a pair is met once.
                c = (x[i : i + 64, None, None] * LEAF + np.arange(LEAF)[None, :, None]) + np.zeros((1, 1, LEAF), int)
                d = (y[i : i + 64, None, None] * LEAF + np.arange(LEAF)[None, None, :]) + np.zeros((1, LEAF, 1), int)
                c, d = c.ravel(), d.ravel()
                inside = (c < size) & (d < size) & ((c <= d) if level else (c < d))
                c, d = c[inside], d[inside]
                if level:
                    stack.append((level - 1, c, d))
                    continue
                linked = self.points_may_link(c, d)
                yield self.order[c[linked]], self.order[d[linked]]


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sets link; `texts` has a text for each node."""
    one = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = one.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 128):
                part = batch.slice(low, 128)
                sets = []
                for name in ("text_a", "text_b"):
                    held: list[np.ndarray] = []
                    for _, hashes, bounds in shingle_sets(part.column(name)):
                        held += [hashes[bounds[i] : bounds[i + 1]] for i in range(len(bounds) - 1)]
                    sets.append(held)
                shared = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*sets)]
                links = [WHOLE * s >= PART * (len(x) + len(y) - s) for s, x, y in zip(shared, *sets)]
                yield part.select(["a", "b"]).filter(pa.array(links, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, n_shingles and component_id for each row of (doc_id, text).

    component_id is the smallest doc_id that links reach from the row, its own if there is none; links join
    sets of SHINGLE words with a Jaccard similarity of at least 0.8. Null, empty and blank texts have no
    shingles and link with nothing. Rows with equal sets are in one component; a null doc_id is never the
    smallest unless it is the only one.
    """
    return labels(docs, buckets).select("doc_id", "n_shingles", "component_id")


def labels(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """`near_duplicates` with t and n_chars, which tell a row's text, and the number of its component (null: no set)."""
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    profiled = stored(profile(docs), "profile")
    rows = profiled.where("chunk IS NULL").drop("chunk")
    sets = stored(
        rows.where("n > 0").groupBy("sig").agg(
            F.min("doc_id").alias("smallest"), F.min(F.struct("t", "n_chars")).alias("own"), F.first("point").alias("point"),
            F.first("node").alias("node"),
        ),
        "sets",
    )
    lists = stored(key_lists(docs, rarity(profiled), buckets), "lists")
    lists = stored(lists.groupBy("members").agg(F.sum("shared").alias("shared")), "lists")
    texts = stored(_texts_of(docs, sets, lists), "texts")
    held = sets.select("node", "point")
    first = stored(verified(_bounded(_stars(lists), held), texts), "links")
    known = stored(components(first), "components")
    nearest = stored(_across(_members(lists), known, held, nearest=True), "nearest")
    second = stored(verified(nearest.select("a", "b").distinct(), texts), "links")
    found = first.union(second)
    known = stored(components(found), "components")
    open_lists = nearest.where("more").select("list").distinct()
    rest = _across(_members(lists).join(open_lists, "list", "left_semi"), known, held)
    third = stored(verified(rest.select("a", "b").distinct(), texts), "links")
    every = stored(components(found.union(third)), "components")
    return _labelled(rows, sets, every)


def _members(lists: DataFrame) -> DataFrame:
    """(members, shared, nodes): the nodes of each list as an array."""

    def run(batches):
        for batch in batches:
            held = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("members")]
            nodes = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *map(len, held)]), pa.int32()), pa.array(np.concatenate([*held, np.zeros(0, np.int64)]), pa.int64())
            )
            ids = pa.array([hash_of(x) for x in held], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, batch.column("shared"), nodes], ["list", "shared", "nodes"])

    def hash_of(x: np.ndarray) -> int:
        value = mix(x.view(np.uint64) + np.arange(len(x), dtype=np.uint64)).sum(dtype=np.uint64)
        return int(value.astype(np.int64))

    return lists.mapInArrow(run, "list bigint, shared bigint, nodes array<bigint>")


def _texts_of(docs: DataFrame, sets: DataFrame, lists: DataFrame) -> DataFrame:
    """(node, text) for each node of a list; every text moves once per task at most."""
    nodes = _members(lists).select(F.explode("nodes").alias("node")).distinct()
    wanted = sets.join(nodes, "node", "left_semi").select("node", "own.t", "own.n_chars")
    texts = with_text_key(docs).drop("doc_id").dropDuplicates(["t", "n_chars"])
    return texts.join(wanted, ["t", "n_chars"]).select("node", "text")


def _stars(lists: DataFrame) -> DataFrame:
    """Of each node the pair with the first member of a list that it shares the most keys with."""
    each = _members(lists).select(F.explode("nodes").alias("b"), F.get("nodes", F.lit(0)).alias("a"), "shared")
    pairs = each.where("a != b").groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    return pairs.groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("a")).select("a", "b")


def _bounded(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """The pairs whose points allow a link."""
    one = pairs.join(held.select(F.col("node").alias("a"), F.col("point").alias("p")), "a")
    both = one.join(held.select(F.col("node").alias("b"), F.col("point").alias("q")), "b").select("a", "b", "p", "q")

    def run(batches):
        for batch in batches:
            links = []
            for p, q in zip(batch.column("p").to_pylist(), batch.column("q").to_pylist()):
                n = min(len(p), len(q))
                links.append(bool(may_link(folded(p, n), folded(q, n))))
            yield batch.select(["a", "b"]).filter(pa.array(links, pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint")


def _across(members: DataFrame, known: DataFrame, held: DataFrame, nearest: bool = False) -> DataFrame:
    """(list, a, b, more): pairs of a list in different components so far whose points allow a link.

    `nearest` keeps two pairs of each node at most, that with an early node of the list, which makes stars, and
    that with the highest bound; `more` tells whether the list has others.
    """
    each = members.select("list", F.explode("nodes").alias("node"))
    placed = each.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("list").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y")
    rows = placed.join(stored(mixed.select("list"), "mixed"), "list", "left_semi").join(held, "node")
    packed = rows.groupBy("list").agg(F.collect_list(F.struct("node", "component", "point")).alias("rows"))
    kinds = pa.schema([("list", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("more", pa.bool_())])

    def run(batches):
        for batch in batches:
            for name, members in zip(batch.column("list").to_pylist(), batch.column("rows")):
                rows = members.values
                node, component = (rows.field(c).to_numpy() for c in ("node", "component"))
                held = rows.field("point").to_pylist()
                rank = np.argsort(np.argsort(node))
                order, near = np.argsort(node), Nearest(len(node))
                for x, y in Tree(np.stack([folded(p, GROUPS) for p in held])).pairs():
                    apart = component[x] != component[y]
                    x, y, bound = finer(held, x[apart], y[apart])
                    low, high = np.minimum(rank[x], rank[y]), np.maximum(rank[x], rank[y])
                    if nearest:
                        near.add(low, high, bound)
                    else:
                        yield sent(name, node[order[low]], node[order[high]], False)
                if nearest:
                    low, high = near.pairs()
                    yield sent(name, node[order[low]], node[order[high]], near.count > len(low))

    def sent(name, a, b, more):
        n = len(a)
        columns = [np.full(n, name, np.int64), a, b, np.full(n, more)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=kinds)

    return packed.select("list", "rows").mapInArrow(run, "list bigint, a bigint, b bigint, more boolean")


def _labelled(rows: DataFrame, sets: DataFrame, found: DataFrame) -> DataFrame:
    """Each row with the smallest doc_id of its component."""
    own = sets.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    own = stored(own.select("sig", "smallest", "component"), "labels")
    least = stored(own.groupBy("component").agg(F.min("smallest").alias("component_id")), "least")
    by_sig = stored(own.join(least, "component").select("sig", "component", "component_id"), "labels")
    out = rows.join(by_sig, "sig", "left")
    component_id = F.coalesce("component_id", "doc_id").alias("component_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component_id, "t", "n_chars", "component")


def keep_one(df: DataFrame) -> DataFrame:
    """One row of each component: that with the smallest doc_id, and of these that with the smallest text hash.

    Rows are told apart by id and text, so a row that only shares its id with a near copy stays. Of rows that
    repeat id and text the one with the smallest further columns stays. Rows without shingles or without an
    id stay; columns stay.
    """
    key, names = ["doc_id", "t", "n_chars"], ["doc_id", "_j_t", "_j_n"]
    every = stored(labels(df.select("doc_id", "text")), "labels")
    grouped = F.col("component").isNotNull() & F.col("doc_id").isNotNull()
    found = every.where(grouped).groupBy(*key, "component").agg(F.count("*").alias("rows"))
    first = found.groupBy("component").agg(F.min(F.struct(*key)).alias("first"))
    found = found.join(first, "component").withColumn("_j_gone", F.col("first") != F.struct(*key))
    found = found.withColumn("_j_many", ~F.col("_j_gone") & (F.col("rows") > 1)).select(*key, "_j_gone", "_j_many")
    others = every.where(~grouped).select(*key, F.lit(False).alias("_j_gone"), F.lit(False).alias("_j_many"))
    told = stored(found.union(others.distinct()).toDF(*names, "_j_gone", "_j_many"), "found")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = df.withColumns({"_j_t": F.xxhash64(text), "_j_n": F.length(text)})
    kept = with_membership(rows, told, names, "_j_gone").where(~F.col("_j_gone")).drop("_j_gone")
    if not told.where("_j_many").isEmpty():
        kept = with_membership(kept, told, names, "_j_many")
        one = kept.where("_j_many").groupBy(*names).agg(F.min(F.struct(*df.columns)).alias("_row"))
        kept = kept.where(~F.col("_j_many")).select(df.columns).union(one.select("_row.*"))
    return kept.select(df.columns)
