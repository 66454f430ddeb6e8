"""Parquet tables that a job may read and replace.

A path cannot be overwritten while it is read. So each write of a table goes to a new folder
store_version=<n>, and counts once that folder has the mark _SUCCESS. A job that dies leaves a folder
without the mark, which readers never see.

A version holds one of three things:

* the whole table, which replaces the one before;
* some buckets of a table that is kept in key buckets (store_buckets=<of how many>/store_bucket=<number>):
  a bucket is read from the latest version that has it, so an upsert writes the buckets of its batch only;
  beside them the buckets of its key indexes (store_index=<columns>/...), under the same mark;
* changes of a type-2 history: versions that were opened and versions that were closed (store_segment).
  Open versions are those of the last base (segment open) and opened since, less those closed since.
"""

import json
import math
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.operators.snapshot import SCD_ID, VALID_TO

# Partition columns of the folders, named so that no table column clashes with them.
VERSION, SEGMENT = "store_version", "store_segment"
BUCKETS, BUCKET, INDEX = "store_buckets", "store_bucket", "store_index"
OPEN, OPENED, CLOSED = "open", "opened", "closed"
#: Mark of a bucket that has no rows any more.
EMPTY = "_empty"
#: Parquet bytes that a bucket is meant to have; beyond GROWTH times as much on average, buckets are split.
BUCKET_BYTES, GROWTH = 128 << 20, 4
#: Runs whose changes a reader of a history puts together; then a new base is written.
COMPACT_AFTER = 30
#: Parquet bytes that a file of changes is meant to have; those of a run are put together if they are CROWD times as many as needed.
FILE_BYTES, CROWD = 16 << 20, 4
_UNMARKED = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


def bucket_number(keys: Sequence[Column], buckets: int) -> Column:
    """The bucket of a key; keys have to be of the types the table has."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class Version:
    """A version being written. Nothing of it is visible before `commit`."""

    def __init__(self, store: "Store", table: str, path: str):
        self.store, self.table, self.path = store, table, path

    def write_buckets(self, rows: DataFrame, buckets: int, index: str | None = None, chosen: Iterable[int] = ()) -> None:
        """Write the rows, which have their bucket in BUCKET; `chosen` buckets without rows are marked as empty."""
        path = f"{self._at(index)}/{BUCKETS}={buckets}"
        rows.write.mode("error").options(**_UNMARKED).partitionBy(BUCKET).parquet(path)
        filled = {int(p.getName().split("=")[1]) for p in self.store._glob(f"{path}/{BUCKET}=*")} if chosen else set()
        for bucket in set(chosen) - filled:
            mark, fs = self.store._hadoop(f"{path}/{BUCKET}={bucket}/{EMPTY}")
            fs.create(mark).close()

    def _at(self, index: str | None) -> str:
        return f"{self.path}/{INDEX}={index}" if index else self.path

    def read_buckets(self, buckets: int, schema: T.StructType, index: str | None = None) -> DataFrame:
        """What `write_buckets` wrote; an empty frame if there were no rows."""
        path = f"{self._at(index)}/{BUCKETS}={buckets}"
        if not self.store._glob(f"{path}/{BUCKET}=*/*.parquet"):
            return self.store.spark.createDataFrame([], schema)
        return self.store.spark.read.schema(schema).parquet(path)

    def commit(self) -> None:
        mark, fs = self.store._hadoop(f"{self.path}/_SUCCESS")
        fs.create(mark).close()


class Store:
    def __init__(
        self, spark: SparkSession, root: str, bucket_bytes: int = BUCKET_BYTES, compact_after: int = COMPACT_AFTER
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.bucket_bytes = bucket_bytes
        self.compact_after = compact_after

    def path(self, table: str) -> str:
        """`table` is schema.name, for example stg.flights."""
        return f"{self.root}/{table.replace('.', '/')}"

    def _hadoop(self, path: str):
        """A Hadoop path and its file system, so that any storage Spark reads will do."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _glob(self, pattern: str) -> list:
        path, fs = self._hadoop(pattern)
        return [s.getPath() for s in fs.globStatus(path) or []]

    def _listing(self, table: str) -> tuple[list[int], list[int]]:
        """Versions that are complete, and all that have a folder."""
        number = lambda path: int(path.getName().split("=")[1])
        numbers = sorted(number(p) for p in self._glob(f"{self.path(table)}/{VERSION}=*"))
        done = self._glob(f"{self.path(table)}/{VERSION}=*/_SUCCESS")
        complete = sorted(number(p.getParent()) for p in done)
        return complete, numbers

    def versions(self, table: str) -> list[int]:
        return self._listing(table)[0]

    def exists(self, table: str) -> bool:
        return bool(self.versions(table))

    def _live(self, table: str) -> tuple[int, list[int]]:
        complete = self.versions(table)
        if not complete:
            raise LookupError(f"{table} has not been written under {self.root}")
        return complete[-1], complete

    def _next_path(self, table: str) -> str:
        numbers = self._listing(table)[1]
        return f"{self.path(table)}/{VERSION}={(numbers[-1] if numbers else 0) + 1}"

    def begin(self, table: str) -> Version:
        return Version(self, table, self._next_path(table))

    # Whole tables and tables in buckets.

    def read(self, table: str) -> DataFrame:
        if self.buckets(table):
            return self.read_buckets(table).drop(BUCKET)
        live, _ = self._live(table)
        return self.spark.read.parquet(f"{self.path(table)}/{VERSION}={live}")

    def write(self, table: str, df: DataFrame, check: Callable[[DataFrame], None] | None = None) -> None:
        """Replace the table; fails when another writer took the same version.

        `check` sees the rows as written and may raise; the version then stays unmarked,
        which leaves the table as it was.
        """
        path = self._next_path(table)
        if check is None:
            df.write.mode("error").parquet(path)
            return
        df.write.mode("error").options(**_UNMARKED).parquet(path)
        check(self.spark.read.parquet(path))
        Version(self, table, path).commit()

    def _bucket_files(self, table: str, index: str | None = None) -> list[tuple[int, int, int, int]]:
        """(version, buckets, bucket, bytes) of every file of a complete version; an empty bucket has 0 bytes."""
        inner = f"/{INDEX}={index}" if index else ""
        path, fs = self._hadoop(f"{self.path(table)}/{VERSION}=*{inner}/{BUCKETS}=*/{BUCKET}=*/*")
        complete, out = set(self.versions(table)), []
        for status in fs.globStatus(path) or []:
            at = status.getPath()
            size = 0 if at.getName() == EMPTY else status.getLen()
            bucket, of = at.getParent(), at.getParent().getParent()
            version = of.getParent().getParent() if index else of.getParent()
            found = tuple(int(p.getName().split("=")[1]) for p in (version, of, bucket))
            if found[0] in complete:
                out.append((*found, size))
        return out

    @staticmethod
    def _latest(files: Iterable[tuple[int, int, int, int]]) -> tuple[int, dict[int, int]]:
        """How many buckets the table has, and the version that each one is read from."""
        files = list(files)
        if not files:
            return 0, {}
        of = max(files)[1]
        latest: dict[int, int] = {}
        for version, buckets, bucket, _ in files:
            if buckets == of:
                latest[bucket] = max(version, latest.get(bucket, 0))
        return of, latest

    def buckets(self, table: str, index: str | None = None) -> int:
        """How many buckets a table or index is kept in; 0 if it is not in buckets."""
        live = self.versions(table)
        files = self._bucket_files(table, index) if live else []
        if not index and files and max(files)[0] < live[-1] and self._replaced(table, live[-1]):
            return 0
        return self._latest(files)[0]

    def _replaced(self, table: str, version: int) -> bool:
        """Whether a version is a whole table and not a set of buckets."""
        return bool(self._glob(f"{self.path(table)}/{VERSION}={version}/*.parquet"))

    def read_buckets(self, table: str, chosen: Iterable[int] | None = None, index: str | None = None) -> DataFrame | None:
        """The chosen buckets, or all, with their numbers in BUCKET; None if none of them has a row."""
        files = self._bucket_files(table, index)
        of, latest = self._latest(files)
        filled = {(v, k) for v, b, k, size in files if b == of and size}
        wanted = set(latest if chosen is None else chosen)
        inner = f"{INDEX}={index}/" if index else ""
        paths = [
            f"{self.path(table)}/{VERSION}={version}/{inner}{BUCKETS}={of}/{BUCKET}={bucket}"
            for bucket, version in sorted(latest.items())
            if bucket in wanted and (version, bucket) in filled
        ]
        if not paths:
            return None
        rows = self.spark.read.option("basePath", self.path(table)).parquet(*paths)
        return rows.drop(VERSION, BUCKETS, INDEX)

    def wanted_buckets(self, total: int) -> int:
        """A power of two, so that splitting a bucket takes nothing from others, with room to grow."""
        return 1 << max(0, math.ceil(math.log2(max(1, total) / self.bucket_bytes)))

    def crowded(self, table: str) -> int:
        """How many buckets the table should have, if those it has are far too large; else 0."""
        of, total = self.buckets(table), self.live_bytes(table)
        return self.wanted_buckets(total) if of and total > GROWTH * self.bucket_bytes * of else 0

    def live_bytes(self, table: str) -> int:
        """Bytes of the buckets that readers of a table see."""
        files = self._bucket_files(table)
        of, latest = self._latest(files)
        return sum(size for version, buckets, bucket, size in files if buckets == of and latest[bucket] == version)

    def folder_bytes(self, path: str) -> int:
        at, fs = self._hadoop(path)
        return fs.getContentSummary(at).getLength()

    # Type-2 histories.

    def _history_path(self, table: str, schema: T.StructType) -> str:
        path = self._next_path(table)
        at, fs = self._hadoop(f"{path}/_schema")
        out = fs.create(at)
        out.write(bytearray(json.dumps(schema.jsonValue()).encode()))
        out.close()
        return path

    def _write_segments(self, table: str, parts: Iterable[DataFrame], opened: str) -> None:
        """Write the rows of `parts`, one part after the other, as one version."""
        segment, path = F.when(F.col(VALID_TO).isNull(), opened).otherwise(CLOSED), None
        for rows in parts:
            path = path or self._history_path(table, rows.schema)
            self._append_segments(rows.withColumn(SEGMENT, segment), path)
        if opened == OPENED:
            self._join_small_files(path, T.StructType([*rows.schema.fields, T.StructField(SEGMENT, T.StringType())]))
        Version(self, table, path).commit()

    @staticmethod
    def _append_segments(rows: DataFrame, path: str) -> None:
        rows.write.mode("append").options(**_UNMARKED).partitionBy(SEGMENT).parquet(path)

    def _join_small_files(self, path: str, schema: T.StructType) -> None:
        """Put the files of a version that is not marked yet together, if there are far more than its bytes need."""
        files = self._glob(f"{path}/{SEGMENT}=*/*.parquet")
        wanted = max(1, math.ceil(self.folder_bytes(path) / FILE_BYTES))
        if len(files) <= CROWD * wanted:
            return
        old = [f.toString() for f in files]
        rows = self.spark.read.schema(schema).option("basePath", path).parquet(*old)
        self._append_segments(rows.coalesce(wanted), path)
        self._delete(old)

    def write_history(self, table: str, step: DataFrame) -> None:
        """Store the result of `snapshot_step`, all of whose open versions are a new base.

        Closed versions are written once and never again.
        """
        self._write_segments(table, [step], OPEN)

    def append_history(self, table: str, *changes: DataFrame) -> None:
        """Store the result of `snapshot_changes`: only versions that a run opened or closed.

        Changes given in parts are computed and written one after the other, and count when all of them are.
        The first run of a table is its base. After COMPACT_AFTER runs a new base is written.
        """
        base, complete = self._base(table)
        first = not complete
        # Few changes become few files, many stay where they were compared: a shuffle of them takes several times their files.
        self._write_segments(table, changes, OPEN if first else OPENED)
        if sum(v > base for v in complete) + 1 >= self.compact_after and not first:
            self.compact_history(table)

    def compact_history(self, table: str) -> None:
        """Write all open versions as a new base, so that readers need no earlier changes."""
        self._write_segments(table, [self.read_open(table)], OPEN)

    def _segments(self, table: str, name: str) -> list[int]:
        found = self._glob(f"{self.path(table)}/{VERSION}=*/{SEGMENT}={name}")
        return sorted(int(p.getParent().getName().split("=")[1]) for p in found)

    def _base(self, table: str, at: int | None = None) -> tuple[int, list[int]]:
        """The version of the base that readers of version `at` (default: the last) start from."""
        complete = [v for v in self.versions(table) if at is None or v <= at]
        return max([v for v in self._segments(table, OPEN) if v in complete], default=0), complete

    def _read_segments(self, table: str, parts: list[tuple[int, str]], live: int) -> DataFrame:
        path, fs = self._hadoop(f"{self.path(table)}/{VERSION}={live}/_schema")
        paths = [f"{self.path(table)}/{VERSION}={v}/{SEGMENT}={name}" for v, name in parts]
        if not fs.exists(path):
            return self.spark.read.parquet(*paths)
        stream = fs.open(path)
        schema = T.StructType.fromJson(json.loads(bytes(stream.readAllBytes())))
        stream.close()
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read_open(self, table: str) -> DataFrame:
        """The open versions: of the base and opened since, less those closed since."""
        live, _ = self._live(table)
        base, complete = self._base(table)
        since = [v for v in complete if v > base]
        opened = [v for v in self._segments(table, OPENED) if v in since]
        closed = [v for v in self._segments(table, CLOSED) if v in since]
        rows = self._read_segments(table, [*([(base, OPEN)] if base else []), *((v, OPENED) for v in opened)], live)
        if not closed:
            return rows
        gone = self._read_segments(table, [(v, CLOSED) for v in closed], live).select(SCD_ID)
        return rows.join(gone, SCD_ID, "left_anti").select(rows.columns)

    def read_history(self, table: str) -> DataFrame:
        """Open versions and the closed versions of all runs."""
        live, complete = self._live(table)
        closed = [v for v in self._segments(table, CLOSED) if v in complete]
        rows = self.read_open(table)
        if not closed:
            return rows
        return self._read_segments(table, [(v, CLOSED) for v in closed], live).select(rows.columns).unionByName(rows)

    def drop_superseded(self, table: str, keep: int = 2) -> None:
        """Delete what no reader of the last `keep` versions needs.

        Of a history that are open rows which a later base has; closed rows are kept. Of a table in buckets
        it is each bucket that a later one replaces.
        """
        complete, numbers = self._listing(table)
        oldest = (complete or [0])[-keep:][0]
        if any(self._segments(table, name) for name in (OPEN, OPENED, CLOSED)):
            base = self._base(table, oldest)[0]
            for name in (OPEN, OPENED):
                self._delete(f"{self.path(table)}/{VERSION}={v}/{SEGMENT}={name}" for v in self._segments(table, name) if v < base)
            return
        if not self.buckets(table):
            self._delete(f"{self.path(table)}/{VERSION}={n}" for n in numbers if n < oldest)
            return
        indexes = {p.getName().split("=", 1)[1] for p in self._glob(f"{self.path(table)}/{VERSION}=*/{INDEX}=*")}
        for index in (None, *sorted(indexes)):
            files = self._bucket_files(table, index)
            of, needed = self._latest(f for f in files if f[0] <= oldest)
            inner = f"{INDEX}={index}/" if index else ""
            old = {f[:3] for f in files if f[0] < oldest and (f[1] != of or f[0] != needed.get(f[2]))}
            self._delete(f"{self.path(table)}/{VERSION}={v}/{inner}{BUCKETS}={b}/{BUCKET}={k}" for v, b, k in sorted(old))

    def _delete(self, paths: Iterable[str]) -> None:
        for path in paths:
            at, fs = self._hadoop(path)
            fs.delete(at, True)
