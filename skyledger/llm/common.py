"""Helpers that several corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import StructField, StructType

#: ASCII white space, the separators of words, as a class of a regular expression.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that numpy code handles at once; a longer text is handled alone.
SLICE_BYTES = 1 << 20
#: Rows that Python objects are made of at once.
ROWS = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def map_text(
    df: DataFrame, source: str, make: Callable[[], Callable[[str], tuple]], fields: dict[str, pa.DataType]
) -> DataFrame:
    """Replace the column `source` by the columns `fields`, computed for each text.

    `make` builds the function once per task; it gets "" for null and returns a tuple in the order of
    `fields`. Other columns stay, but for those that `fields` names.
    """
    kept = [f for f in df.schema.fields if f.name != source and f.name not in fields]
    schema = StructType(kept + [StructField(n, from_arrow_type(t)) for n, t in fields.items()])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                rows = [one(t or "") for t in part.column(source).to_pylist()]
                made = [pa.array([r[i] for r in rows], t) for i, t in enumerate(fields.values())]
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + made, schema.names)

    return df.select(*(F.col(f"`{n}`") for n in names), F.col(f"`{source}`")).mapInArrow(run, schema)


def byte_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """UTF-8 bytes of a string column (null: empty) in runs of whole rows of about `limit` bytes.

    Yields the first row, the bytes, and the row bounds within these bytes.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.cast(pa.large_binary()).fill_null(b"")
    _, bounds, data = values.buffers()
    bounds = np.frombuffer(bounds, np.int64, len(values) + 1, values.offset * 8) if len(values) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    low = 0
    while low < len(values):
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + limit, "right")) - 1)
        yield low, data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low]
        low = high


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one, so that any of their bits can be used."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def scratch(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir, which checkpoint() is then told to use.

    Where the setting is missing, as in tests on a local master, a folder under /tmp is named once.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = f"file:///tmp/skyledger-{uuid.uuid4().hex}"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the JVM ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return path.toString()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it: short lineage, and lost executors cost no rerun."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, one: Callable[[pa.RecordBatch], pa.RecordBatch], schema, rows: int) -> DataFrame:
    """Apply `one` to Arrow batches of at most `rows` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, rows):
                yield one(batch.slice(low, rows))

    return df.mapInArrow(run, schema)
