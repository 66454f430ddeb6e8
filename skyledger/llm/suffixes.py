"""Removal of passages that a document with a smaller id has, by refinement of suffix buckets.

Suffixes are bucketed by their first Q bytes, and buckets are refined by the identifiers of later offsets:
the identifier of 2 Q bytes is made of those at an offset and Q bytes on, and so forth up to LENGTH bytes,
each step using those made before. To sort every suffix of a corpus would move many times its size, so a
sparse set of suffixes is sorted: of the Q-byte strings within each window of LENGTH bytes the one with the
smallest identifier is an anchor, and neighbouring windows with one anchor form a run. The choice depends
on the window alone, so equal windows have equal anchors at equal places.

1. Runs meet in the bucket of their anchor and are refined by the identifier of all of the run's bytes.
   A run equal to one of a smaller id is removed. Of first runs the anchor's bucket is refined by the 2 Q
   bytes from the anchor on and by those that end with it. Each window holds one of these two, so windows
   for which that bucket has one document are done.
2. The windows left are refined to LENGTH bytes and meet once more; one that a smaller id has is removed.

Tasks resolve what they hold first and send one document for each identifier, so that a passage which
very many documents share is a row for each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import byte_slices, mix, stored
from skyledger.llm.syncmers import sliding_min, words_at

LENGTH, Q = 50, 16
#: Runs that a task resolves and sends at once, and first runs of one anchor that are too many to be sent.
FLUSH, CROWD = 1_000_000, 256
#: Bytes of text whose runs a bucket is meant to hold.
BUCKET_BYTES = 8 << 20
_A, _B, _C, _D = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))

#: Columns of the runs and windows that are sent, and the low bytes of each that are kept.
RUN = {
    "anchor": ("<u8", 6), "whole": ("<u8", 6), "right": ("<u1", 1), "left": ("<u1", 1), "id": ("<i8", 8), "h": ("<i8", 6),
    "at": ("<u4", 4), "more": ("<u1", 1), "lead": ("<u1", 1),
}
WINDOW = {"window": ("<u8", 8), "check": ("<u4", 4), "id": ("<i8", 8), "h": ("<i8", 6), "at": ("<u4", 4)}
BLOCK = "bucket int, rows int, block binary, id bigint, h bigint, gone binary, open binary"


def identifiers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Identifiers of the Q, 2 Q and LENGTH bytes from each position at which there are as many."""
    n = len(data)
    words = words_at(data)
    short = mix(words[: n - Q + 1] * _A + words[8 : n - Q + 9])
    double = mix(short[: n - 2 * Q + 1] * _B + short[Q:])
    full = mix(double[: n - LENGTH + 1] * _C + double[LENGTH - 2 * Q :])
    return short, double, full


def runs(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """Text number, first window, further windows, lead and identifiers of each run of the texts.

    `lead` is how far the anchor is behind the first window; `right` and `left` are of the 2 Q bytes from the
    anchor on and to its end. They cross the bounds of the text only where no window of the run holds them.
    """
    if len(data) < LENGTH:
        return {n: np.zeros(0, np.int64 if n == "text" else RUN[n][0]) for n in ("text", *RUN) if n not in ("id", "h")}
    short, double, full = identifiers(data)
    # The position in the low bits makes the leftmost of equal identifiers the smallest.
    mask = np.uint64((1 << max(20, len(data).bit_length())) - 1)
    ranked = (short & ~mask) | np.arange(len(short), dtype=np.uint64)
    anchor = sliding_min(ranked, LENGTH - Q + 1) & mask
    inside = np.ones(len(full) + 1, bool)
    inside[-1] = False
    for b in bounds[1:-1]:
        inside[max(0, b - LENGTH + 1) : b] = False
    same = anchor[1:] == anchor[:-1]
    first = np.flatnonzero(inside[:-1] & ~np.concatenate([[False], inside[:-2] & same]))
    last = np.flatnonzero(inside[:-1] & ~np.concatenate([inside[1:-1] & same, [False]]))
    at = anchor[first].astype(np.int64)
    shape = ((at - first) * 64 + (last - first)).astype(np.uint64)
    text = np.searchsorted(bounds, first, "right") - 1
    found = {
        "at": first - bounds[text],
        "more": last - first,
        "lead": at - first,
        "anchor": short[at] >> np.uint64(16),
        # Two windows less than LENGTH apart hold all bytes between them.
        "whole": (mix(full[first] * _A + full[last] * _B + shape * _D) >> np.uint64(16)) | np.uint64(1),
        "right": double[np.minimum(at, len(double) - 1)] >> np.uint64(56),
        "left": double[np.clip(at - Q, 0, len(double) - 1)] >> np.uint64(56),
    }
    return {"text": text} | {n: x.astype(RUN[n][0]) for n, x in found.items()}


def _bytes(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize)


def packed(rows: dict[str, np.ndarray], kinds: dict) -> bytes:
    """Rows as columns, byte plane by byte plane, so that what is sorted or small packs well."""
    planes = [np.ascontiguousarray(_bytes(rows[n].astype(t))[:, :w].T).tobytes() for n, (t, w) in kinds.items()]
    return pa.compress(b"".join(planes), "zstd", asbytes=True)


def unpacked(blocks: pa.ChunkedArray, counts: pa.ChunkedArray, kinds: dict) -> dict[str, np.ndarray]:
    """The rows of all blocks."""
    found = {n: [] for n in kinds}
    width = sum(w for _, w in kinds.values())
    for block, count in zip(blocks, counts):
        n, low = count.as_py(), 0
        data = np.frombuffer(pa.decompress(block.as_buffer(), n * width, "zstd"), np.uint8)
        for name, (kind, w) in kinds.items():
            values = np.zeros(n, kind)
            _bytes(values)[:, :w] = data[low : low + n * w].reshape(w, n).T
            found[name].append(values)
            low += n * w
    return {n: np.concatenate(x) for n, x in found.items()}


def taken(rows: dict[str, np.ndarray], at: np.ndarray) -> dict[str, np.ndarray]:
    return {n: x[at] for n, x in rows.items()}


def groups(*keys: np.ndarray) -> np.ndarray:
    """Group number of each row, for rows sorted by the keys."""
    new = np.zeros(len(keys[0]), bool)
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.cumsum(new)


def firsts(rows: dict[str, np.ndarray], names: list[str]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The rows sorted by the names and then by id, and which of them have the smallest id of their names."""
    rows = taken(rows, np.lexsort((rows["at"], rows["h"], rows["id"], *(rows[n] for n in names[::-1]))))
    group = groups(*(rows[n] for n in names))
    start = np.searchsorted(group, np.arange(group[-1] + 1 if len(group) else 0))
    return rows, rows["id"] == rows["id"][start][group]


def answers(
    gone: dict[str, np.ndarray], left: dict[str, np.ndarray] | None = None, buckets: int = 1
) -> Iterator[pa.RecordBatch]:
    """Spans by document: those to be removed, and the runs that are open still, as pairs of numbers.

    They take the way of the blocks, through a bucket that their document decides.
    """
    pairs = [(gone, np.stack([gone["at"], gone["at"].astype(np.int64) + LENGTH + gone.get("more", 0)], 1))]
    if left is not None:
        pairs.append((left, np.stack([left["at"], left["more"]], 1)))
    for k, (rows, spans) in enumerate(pairs):
        if not len(rows["id"]):
            continue
        order = np.lexsort((rows["at"], rows["h"], rows["id"]))
        ids, h, spans = rows["id"][order], rows["h"][order], spans[order].astype("<u4")
        edges = np.append(np.flatnonzero(np.append(True, np.diff(groups(ids, h)) > 0)), len(ids))
        for low in range(0, len(edges) - 1, 4096):
            part = edges[low : low + 4097]
            held = pa.array([spans[a:b].tobytes() for a, b in zip(part[:-1], part[1:])], pa.binary())
            nothing, n = pa.nulls(len(held), pa.binary()), len(held)
            way = mix(ids[part[:-1]].view(np.uint64) ^ h[part[:-1]].astype(np.uint64)) % np.uint64(buckets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(way.astype(np.int32)), pa.nulls(n, pa.int32()), nothing, pa.array(ids[part[:-1]]), pa.array(h[part[:-1]]),
                 held if k == 0 else nothing, held if k == 1 else nothing],
                ["bucket", "rows", "block", "id", "h", "gone", "open"],
            )


def blocks(rows: dict[str, np.ndarray], key: str, kinds: dict, buckets: int) -> Iterator[pa.RecordBatch]:
    """A block of rows for each bucket of the key."""
    bucket = ((rows[key] >> np.uint64(8)) % np.uint64(buckets)).astype(np.int32)
    order = np.lexsort((rows["at"], rows["h"], rows["id"], bucket))
    rows, bucket = taken(rows, order), bucket[order]
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        n = int(edges[b + 1] - edges[b])
        block = packed(taken(rows, np.arange(edges[b], edges[b + 1])), kinds)
        none = pa.nulls(1, pa.binary())
        columns = [pa.array([b], pa.int32()), pa.array([n], pa.int32()), pa.array([block], pa.binary())]
        columns += [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), none, none]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "rows", "block", "id", "h", "gone", "open"])


def sent_runs(rows: dict[str, np.ndarray], buckets: int) -> Iterator[pa.RecordBatch]:
    """Resolve the runs of a task: those equal to one of a smaller id go, the first ones are sent.

    An anchor with a crowd of first runs is not sent but for a mark (whole = 0): its runs stay open, which
    spreads them by their windows, and the mark keeps open those that other tasks have.
    """
    rows, first = firsts(rows, ["anchor", "whole"])
    gone, rows = taken(rows, ~first), taken(rows, first)
    group = groups(rows["anchor"])
    crowd = np.bincount(group)[group] > CROWD if len(group) else np.zeros(0, bool)
    yield from answers(gone, taken(rows, crowd), buckets)
    marks = taken(rows, np.flatnonzero(crowd & np.append(True, group[1:] != group[:-1])) if len(group) else crowd)
    marks["whole"] = np.zeros(len(marks["id"]), np.uint64)
    rows = taken(rows, ~crowd)
    yield from blocks({n: np.concatenate([rows[n], marks[n]]) for n in rows}, "anchor", RUN, buckets)


def met_runs(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Resolve a bucket: runs equal to one of a smaller id go; of first ones some windows may stay open."""
    rows, first = firsts(rows, ["anchor", "whole"])
    gone, rows = taken(rows, ~first & (rows["whole"] != 0)), taken(rows, first)
    group = groups(rows["anchor"])
    marked = np.zeros(group[-1] + 1 if len(group) else 0, bool)
    marked[group[rows["whole"] == 0]] = True
    right, left = (shared(group, rows[n], rows["id"]) | marked[group] for n in ("right", "left"))
    lead, more = rows["lead"].astype(np.int64), rows["more"].astype(np.int64)
    # A window that begins k behind the first one holds the bytes to the right if lead - k <= LENGTH - 2 * Q,
    # and those to the left if lead - k >= Q; where it holds both, both are needed.
    low = np.where(left, 0, np.maximum(0, lead - Q + 1))
    high = np.where(right, more, np.minimum(more, lead - (LENGTH - 2 * Q) - 1))
    opened = (right | left) & (low <= high) & (rows["whole"] != 0)
    left_open = {"id": rows["id"], "h": rows["h"], "at": rows["at"].astype(np.int64) + low, "more": high - low}
    yield from answers(gone, taken(left_open, opened))


def shared(group: np.ndarray, value: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether another id has the same group and value."""
    order = np.lexsort((ids, value, group))
    part = groups(group[order], value[order])
    ids = ids[order]
    edges = np.append(np.flatnonzero(np.append(True, np.diff(part) > 0)), len(ids)) if len(ids) else np.zeros(1, np.int64)
    several = ids[edges[:-1]] != ids[edges[1:] - 1]
    out = np.zeros(len(ids), bool)
    out[order] = several[part] if len(ids) else False
    return out


def sent_windows(rows: dict[str, np.ndarray], buckets: int) -> Iterator[pa.RecordBatch]:
    rows, first = firsts(rows, ["window", "check"])
    yield from answers(taken(rows, ~first), None, buckets)
    yield from blocks(taken(rows, first), "window", WINDOW, buckets)


def met_windows(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    rows, first = firsts(rows, ["window", "check"])
    yield from answers(taken(rows, ~first))


def task(make: Callable[[pa.RecordBatch], Iterator[dict]], send: Callable, buckets: int) -> Callable:
    """A mapInArrow function that gathers rows and resolves and sends them FLUSH at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        def all_parts():
            return {n: np.concatenate([p[n] for p in parts]) for n in parts[0]}

        for batch in batches:
            for rows in make(batch):
                parts.append(rows)
                size += len(rows["id"])
                if size >= FLUSH:
                    yield from send(all_parts(), buckets)
                    parts, size = [], 0
        if size:
            yield from send(all_parts(), buckets)

    return run


def meet(sent: DataFrame, kinds: dict, resolve: Callable) -> DataFrame:
    """Bring the blocks of each bucket together; answers that are known already pass through."""

    def run(group: pa.Table) -> pa.Table:
        is_block = group.column("block").is_valid()
        passed, sent = group.filter(pc.invert(is_block)).select(schema.names), group.filter(is_block)
        if not sent.num_rows:
            return passed
        rows = unpacked(sent.column("block"), sent.column("rows"), kinds)
        made = pa.Table.from_batches([b.select(schema.names) for b in resolve(rows)], schema)
        return pa.concat_tables([passed.cast(schema), made])

    schema = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("gone", pa.binary()), ("open", pa.binary())])
    return sent.groupBy("bucket").applyInArrow(run, "id bigint, h bigint, gone binary, open binary")


def run_rows(batch: pa.RecordBatch) -> Iterator[dict]:
    ids, h = (batch.column(n).to_numpy() for n in ("id", "h"))
    for low, data, bounds in byte_slices(batch.column("text")):
        found = runs(data, bounds)
        row = found.pop("text") + low
        yield {**found, "id": ids[row], "h": h[row]}


def window_rows(batch: pa.RecordBatch) -> Iterator[dict]:
    ids, h, opened = batch.column("id").to_numpy(), batch.column("h").to_numpy(), batch.column("open")
    for low, data, bounds in byte_slices(batch.column("text")):
        if len(data) < LENGTH:
            continue
        _, double, full = identifiers(data)
        row, first, more = [], [], []
        for i in range(len(bounds) - 1):
            spans = spans_of([opened[low + i].as_py()])
            row.append(np.full(len(spans), i))
            first.append(spans[:, 0])
            more.append(spans[:, 1])
        row, first, more = (np.concatenate(x).astype(np.int64) for x in (row, first, more))
        row, first, n = np.repeat(row, more + 1), np.repeat(first, more + 1), more + 1
        at = first + np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)
        p = at + bounds[row]
        check = mix(double[p] + double[p + LENGTH - 2 * Q] * _D) >> np.uint64(32)
        yield {
            "window": full[p], "check": check.astype(np.uint32), "id": ids[row + low], "h": h[row + low], "at": at.astype(np.uint32)
        }


def spans_of(parts: list[bytes] | None) -> np.ndarray:
    return np.frombuffer(b"".join(parts or []), "<u4").reshape(-1, 2)


def joined(spans: np.ndarray) -> np.ndarray:
    """The same bytes as fewest spans, by start."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    end = np.maximum.accumulate(spans[:, 1])
    first = np.append(True, spans[1:, 0] > end[:-1])
    return np.stack([spans[first, 0], end[np.append(first[1:], True)]], 1)


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Make the answers of each document one: spans to be removed as fewest, open runs one after the other."""
    for batch in batches:
        gone = [joined(spans_of(x)).astype("<u4").tobytes() if x else None for x in batch.column("gone").to_pylist()]
        opened = [b"".join(x) if x else None for x in batch.column("open").to_pylist()]
        columns = [batch.column("id"), batch.column("h"), pa.array(gone, pa.binary()), pa.array(opened, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "h", "gone", "open"])


def bucket_count(texts: DataFrame) -> int:
    """One for each BUCKET_BYTES of text, and as many as the session has shuffle partitions at least."""
    size = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    return max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))


def cut(data: bytes, spans: np.ndarray) -> tuple[int, int, str]:
    """Bytes removed, maximal runs of these, and the digest of the rest."""
    kept, at, n, removed = hashlib.sha256(), 0, 0, 0
    end = -1
    for low, high in spans[np.argsort(spans[:, 0], kind="stable")].tolist():
        if low > end:
            kept.update(data[at:low])
            n += 1
        if high > max(end, low):
            removed += high - max(end, low)
        at = end = max(end, high)
    kept.update(data[at:])
    return removed, n, kept.hexdigest()


def repeated_passages(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each row of (doc_id, text).

    Every byte goes that is covered by LENGTH bytes which also start in a document with a smaller doc_id.
    Null texts are empty and texts of fewer bytes keep all. A null doc_id counts as the largest. Rows of one
    id take nothing from each other; equal rows have equal results. Rows of one id, or of none, are told
    apart by 48 bits of a hash of their texts.
    """
    largest = F.lit(2**63 - 1).cast("bigint")
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    texts = texts.withColumns({"id": F.coalesce("doc_id", largest), "h": F.xxhash64("text").bitwiseAND(2**48 - 1)})
    buckets = buckets or bucket_count(texts)
    sent = texts.select("id", "h", "text").mapInArrow(task(run_rows, sent_runs, buckets), BLOCK)
    known = meet(sent, RUN, met_runs)
    known = known.groupBy("id", "h").agg(F.collect_list("gone").alias("gone"), F.collect_list("open").alias("open"))
    known = stored(known.mapInArrow(merged, "id bigint, h bigint, gone binary, open binary"), "known")
    opened = known.where(F.col("open").isNotNull()).select("id", "h", "open")
    # The same columns of the texts as below, so that one shuffle of texts serves both.
    asked = texts.join(opened, ["id", "h"]).select("doc_id", "id", "h", "text", "open")
    windows = asked.mapInArrow(task(window_rows, sent_windows, buckets), BLOCK)
    late = meet(windows, WINDOW, met_windows).groupBy("id", "h").agg(F.collect_list("gone").alias("late"))
    early = known.where(F.col("gone").isNotNull()).select("id", "h", "gone")
    spans = early.join(late, ["id", "h"], "full_outer")

    def finish(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                data = [t.encode() for t in part.column("text").to_pylist()]
                parts = zip(part.column("gone").to_pylist(), part.column("late").to_pylist())
                made = [cut(d, spans_of([*([early] if early else []), *(late or [])])) for d, (early, late) in zip(data, parts)]
                columns = [part.column("doc_id"), pa.array([len(d) for d in data], pa.int64())]
                columns += [pa.array([m[k] for m in made], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return texts.join(spans, ["id", "h"], "left").select("doc_id", "text", "gone", "late").mapInArrow(finish, schema)
