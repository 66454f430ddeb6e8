"""Document fingerprints from closed syncmers.

A k-mer of a text's bytes is chosen if the smallest hash of its inner s-mers is that of the first or of
the last one. The choice depends on the k-mer alone, so equal passages give equal anchors wherever they
stand, and of any K - S + 1 neighbouring s-mers at least one edge is an anchor. A fingerprint holds the
SKETCH smallest hashes of a text's anchors; the likeness of two is the estimate of Jaccard similarity that
two such samples allow.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import byte_slices, mix, stored

#: Bytes of a k-mer and of its inner s-mers, and hashes in a fingerprint.
K, S, SKETCH = 24, 8, 64


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as a number; zeros follow the last byte."""
    padded = np.concatenate([data, np.zeros(16 - len(data) % 8, np.uint8)])
    out = np.empty((len(padded) - 8) // 8 * 8, np.uint64)
    for i in range(8):
        out[i::8] = np.frombuffer(padded, "<u8", len(out) // 8, i)
    return out[: len(data)]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` neighbours, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, position and 32-bit hash of every closed syncmer of the texts between `bounds`."""
    inner = K - S
    if len(data) < K:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint32)
    h = mix(words_at(data))[: len(data) - S + 1]
    least = sliding_min(h, inner + 1)
    at = np.flatnonzero((h[: len(least)] == least) | (h[inner:] == least))
    text = np.searchsorted(bounds, at, "right") - 1
    whole = at + K <= bounds[text + 1]
    at, text = at[whole], text[whole]
    parts = h[at] + h[at + S] * np.uint64(3) + h[at + 2 * S] * np.uint64(5)
    return text, at - bounds[text], (mix(parts) >> np.uint64(32)).astype(np.uint32)


def sketches(column: pa.Array) -> list[np.ndarray]:
    """For each text the smallest hashes of its anchors, ascending and without repeats.

    An empty text has none. A text without an anchor, since it is short, has one hash of all of it.
    """
    out: list[np.ndarray] = []
    for _, data, bounds in byte_slices(column):
        text, _, hashes = anchors(data, bounds)
        keys = np.unique((text.astype(np.uint64) << np.uint64(32)) | hashes)
        edges = np.searchsorted(keys >> np.uint64(32), np.arange(len(bounds)))
        for i in range(len(bounds) - 1):
            found = keys[edges[i] : min(edges[i + 1], edges[i] + SKETCH)].astype(np.uint32)
            if not len(found) and bounds[i + 1] > bounds[i]:
                found = np.array([zlib.crc32(data[bounds[i] : bounds[i + 1]].tobytes())], np.uint32)
            out.append(found)
    return out


def written(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the smallest hashes of both that both have; two empty texts are alike."""
    union = np.union1d(a, b)[:SKETCH]
    if not len(union):
        return 1.0
    return float(np.isin(union, a, assume_unique=True).astype(int) @ np.isin(union, b, assume_unique=True)) / len(union)


def fingerprints(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace `text` by `fingerprint`: hexadecimal digits, eight for a hash.

    Null and empty texts have an empty one. Other columns stay, but for one of that name; each row, also
    a repeated one, has its own result.
    """
    kept = [c for c in df.columns if c not in (text, "fingerprint")]
    schema = df.select(*(F.col(f"`{c}`") for c in kept), F.lit("").alias("fingerprint")).schema

    def run(batches):
        for batch in batches:
            made = pa.array([written(s) for s in sketches(batch.column(text))], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), made], schema.names)

    return df.select(*(F.col(f"`{c}`") for c in [*kept, text])).mapInArrow(run, schema)


def followers(keys: DataFrame) -> DataFrame:
    """For each distinct (id, h, n) the one before it in descending order of id as p_id, p_h, p_n; the first has the last.

    A sort by ranges, then windows within each range; only the ends of the ranges meet in one task.
    """
    order = [F.col("id").desc(), F.col("h")]
    placed = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(placed.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "order")
    own = F.struct("id", "h", "n")
    ends = placed.groupBy("_part").agg(F.max_by(own, "_at").alias("_last"))
    every = Window.orderBy("_part")
    wrap = F.last("_last").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = ends.select("_part", F.coalesce(F.lag("_last").over(every), wrap).alias("_before"))
    before = F.lag(own).over(Window.partitionBy("_part").orderBy("_at"))
    found = placed.join(ends, "_part").withColumn("_before", F.coalesce(before, F.col("_before")))
    return found.select("id", "h", *(F.col(f"_before.{c}").alias(f"p_{c}") for c in ("id", "h", "n")))


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text of (doc_id, text), of its edited text, and how like they and the next text's are.

    Edited: the last floor(n / 2) code points are replaced by the first as many (or all) of the text of the
    document with the next smaller doc_id, after the smallest that of the largest. Ids come before null;
    texts with one id follow the order of their hashes, and equal rows count as one document and have equal
    results. Texts move once, their heads once more, both packed.
    """
    content = F.coalesce(F.col("text"), F.lit(""))
    lowest = F.lit(-(2**63)).cast("bigint")
    rows = docs.select("doc_id", content.alias("text")).withColumns(
        {"id": F.coalesce(F.col("doc_id"), lowest), "h": F.xxhash64(F.col("doc_id").isNull(), "text"), "n": F.length("text")}
    )
    links = stored(followers(rows.select("id", "h", "n").distinct()), "followers")

    def shrink(batches):
        pack = zstandard.ZstdCompressor(9).compress
        for batch in batches:
            column = pa.array([pack(t.encode()) for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "id", "h")), column], ["doc_id", "id", "h", "packed"])

    small = rows.select("doc_id", "id", "h", "text").mapInArrow(shrink, "doc_id bigint, id bigint, h bigint, packed binary")
    texts = small.join(links, ["id", "h"])

    def send(batches):
        pack, unpack = zstandard.ZstdCompressor(9).compress, zstandard.ZstdDecompressor().decompress
        for batch in batches:
            texts = [unpack(x).decode() for x in batch.column("packed").to_pylist()]
            made = [s.tobytes() for s in sketches(pa.array(texts, pa.string()))]
            heads = [pack(t[: n // 2].encode()) for t, n in zip(texts, batch.column("p_n").to_pylist())]
            columns = [batch.column("p_id"), batch.column("p_h"), pa.array(heads, pa.binary()), pa.array(made, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "h", "head", "next"])

    # With the columns that the other side takes from the same rows too, so that one shuffle of texts serves both.
    heads = texts.select("doc_id", "packed", "p_id", "p_h", "p_n").mapInArrow(send, "id bigint, h bigint, head binary, next binary")
    both = texts.join(heads.dropDuplicates(["id", "h"]), ["id", "h"]).select("doc_id", "packed", "head", "next")

    def judge(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = [unpack(x).decode() for x in part.column("packed").to_pylist()]
                heads = [unpack(x).decode() for x in part.column("head").to_pylist()]
                edited = [t[: len(t) - len(t) // 2] + head for t, head in zip(texts, heads)]
                own, changed = sketches(pa.array(texts, pa.string())), sketches(pa.array(edited, pa.string()))
                after = [np.frombuffer(x, np.uint32) for x in part.column("next").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                        pa.array([written(s) for s in own], pa.string()),
                        pa.array([written(s) for s in changed], pa.string()),
                        pa.array([likeness(a, b) for a, b in zip(own, changed)], pa.float64()),
                        pa.array([likeness(a, b) for a, b in zip(own, after)], pa.float64()),
                    ],
                    ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )

    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return both.mapInArrow(judge, schema)
