"""Plain database dumps as a source: only asked tables are read, each by many tasks.

A dump holds the rows of a table between a line `COPY schema.table (columns) FROM stdin;` and a line `\\.`,
one row a line, values parted by tabs and NULL written \\N. A first pass looks for these lines by byte
ranges, in parallel; a line belongs to the range in which it begins. The ranges between the marks of a
table are then split again, so a table is read by as many tasks as it has ranges, and others not at all.
Short ranges are put together where there would be many more tasks than cores.
"""

import json
import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from skyledger.schemas import TABLES
from skyledger.sources.extract import Source
from skyledger.sources.landing import to_landing, with_types

FORMAT = "plain_dump"
SPLIT_BYTES = 64 << 20
#: Bytes that are read at once, and those that the end of a line is looked for in.
CHUNK, LINE = 4 << 20, 1 << 16
MARKS = "path string, start bigint, stop bigint, line string"
_HEAD = re.compile(rb'COPY (?:"?[\w$]+"?\.)?"?([\w$]+)"? \(([^()]*)\) FROM stdin;\r?\n?$')
_END = re.compile(rb"\\\.\r?\n?$")
# The escapes of the format.
_ESCAPES = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v"}
_ESCAPED = re.compile(r"\\(x[0-9A-Fa-f]{1,2}|[0-7]{1,3}|.)", re.DOTALL)


def _plain(m: re.Match) -> str:
    code = m[1]
    if code[0] == "x" and len(code) > 1:
        return chr(int(code[1:], 16))
    if code[0] in "01234567":
        return chr(int(code, 8) & 255)
    return _ESCAPES.get(code, code)


def value(text: str) -> str | None:
    """One field as the database had it."""
    if text == "\\N":
        return None
    return _ESCAPED.sub(_plain, text) if "\\" in text else text


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if re.match(r"[a-z0-9]+:/", path) else (pafs.LocalFileSystem(), path)


def _tasks(whole: list[list], size: int) -> list[list[tuple]]:
    """The byte ranges of files dealt in order to tasks of about `size` bytes, small files together."""
    tasks, room = [], 0
    for path, low, high, columns in whole:
        while low < high:
            if not room:
                tasks.append([])
                room = size
            stop = min(high, low + room)
            tasks[-1].append((path, low, stop, columns))
            room -= stop - low
            low = stop
    return tasks


def _chunks(path: str, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """The lines that begin in a byte range, many at once, with the place of the first."""
    fs, name = _file_system(path)
    with fs.open_input_file(name) as f:
        at = max(0, start - 1)
        f.seek(at)
        rest, skip = b"", start > 0
        while True:
            more = f.read(min(CHUNK, max(LINE, stop - at - len(rest))))
            data = rest + more
            if skip:  # the line that the byte before the range is in
                end = data.find(b"\n")
                if end < 0:
                    if not more:
                        return
                    at, rest = at + len(data), b""
                    continue
                at, data, skip = at + end + 1, data[end + 1 :], False
            if at >= stop:
                return
            # The last line is the one that the last byte of the range is in.
            end = data.find(b"\n", stop - 1 - at) if at + len(data) >= stop else -1
            done = end >= 0 or not more
            end = end if end >= 0 else len(data) if done else data.rfind(b"\n")
            if data[: end + 1]:
                yield at, data[: end + 1]
            if done:
                return
            at, rest = at + end + 1, data[end + 1 :]


def _marks(at: int, data: bytes) -> Iterator[tuple[int, bytes]]:
    """The lines that look like marks, with their places."""
    for begin in (b"COPY ", b"\\."):
        low = 0 if data.startswith(begin) else data.find(b"\n" + begin) + 1
        while low or data.startswith(begin):
            end = data.find(b"\n", low) + 1 or len(data)
            line = data[low:end]
            if _HEAD.match(line) or _END.match(line):
                yield at + low, line
            low = data.find(b"\n" + begin, end - 1) + 1
            if not low:
                break


def _column(values: pa.Array) -> pa.Array:
    """One field of many rows as the database had it."""
    values = pc.if_else(pc.equal(values, "\\N"), pa.scalar(None, pa.string()), values)
    if pc.any(pc.match_substring(values, "\\")).as_py():
        values = pa.array([v if v is None else value(v) for v in values.to_pylist()], pa.string())
    return values


class Ranges(InputPartition):
    """Byte ranges of files: path, first byte, end, columns or None."""

    def __init__(self, ranges: list[tuple]):
        self.ranges = ranges


class DumpReader(DataSourceReader):
    """Marks of the files in `paths`, or the rows of `blocks` as text by the names of the schema."""

    def __init__(self, schema: T.StructType, options: Mapping[str, str]):
        self.names = schema.names
        self.split = int(options.get("split", SPLIT_BYTES))
        self.tasks = int(options.get("tasks", "1"))
        self.paths = json.loads(options.get("paths", "[]"))
        self.blocks = json.loads(options.get("blocks", "null"))

    def partitions(self) -> list[Ranges]:
        """Ranges of `split` bytes; where these are more than `tasks`, longer ones up to SPLIT_BYTES."""
        whole = [(path, 0, size, None) for path, size in self.paths] if self.blocks is None else self.blocks
        total = sum(high - low for _, low, high, _ in whole)
        return [Ranges(found) for found in _tasks(whole, max(self.split, min(SPLIT_BYTES, -(-total // self.tasks))))]

    def read(self, partition: Ranges | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark's way to ask for nothing, where there are no partitions
            return
        for path, start, stop, columns in partition.ranges:
            for at, data in _chunks(path, start, stop):
                if columns is not None:
                    yield self._batch(data, {c: i for i, c in enumerate(columns)})
                    continue
                for place, line in _marks(at, data):
                    row = [path], [place], [place + len(line)], [line.decode()]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in row], ["path", "start", "stop", "line"])

    def _batch(self, data: bytes, place: dict[str, int]) -> pa.RecordBatch:
        lines = pa.array(data.removesuffix(b"\n").split(b"\n"), pa.string())
        rows = pc.split_pattern(pc.utf8_rtrim(lines, "\r\n"), "\t")
        columns = [_column(pc.list_element(rows, place[c])) if c in place else pa.nulls(len(lines), pa.string()) for c in self.names]
        return pa.RecordBatch.from_arrays(columns, self.names)


class DumpFormat(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return DumpReader(schema, self.options)


def _files(path: str) -> list[tuple[str, int]]:
    """The dump's files and their bytes: one, or those of a folder."""
    fs, name = _file_system(path)
    info = fs.get_file_info(name)
    found = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(name, recursive=True))
    prefix = path[: len(path) - len(name)] if path.endswith(name) else ""
    hidden = lambda i: i.base_name.startswith(("_", "."))
    return sorted((prefix + i.path, i.size) for i in found if i.is_file and i.size and not hidden(i))


def _read(spark: SparkSession, schema: T.StructType | str, split: int, **options: list):
    """Two tasks for each core, unless the ranges are fewer or SPLIT_BYTES long."""
    reader = spark.read.format(FORMAT).schema(schema).option("split", split).option("tasks", 2 * spark.sparkContext.defaultParallelism)
    for name, found in options.items():
        reader = reader.option(name, json.dumps(found))
    return reader.load()


def dump_blocks(spark: SparkSession, path: str, split: int = SPLIT_BYTES) -> dict[str, list[list]]:
    """For each table of a dump the places of its rows: file, first byte, end, columns."""
    spark.dataSource.register(DumpFormat)
    marks = _read(spark, MARKS, split, paths=_files(path))
    blocks: dict[str, list[list]] = {}
    head = None
    for mark in sorted(map(tuple, marks.collect())):  # two for each block, and what looks like one in the data
        line, found = mark[3].encode(), _HEAD.match(mark[3].encode())
        if head is None or head[0] != mark[0]:
            head = (mark[0], mark[2], found) if found else None
        elif _END.match(line):
            names = [c.strip().strip('"') for c in head[2][2].decode().split(",")]
            blocks.setdefault(head[2][1].decode(), []).append([head[0], head[1], mark[1], names])
            head = None
    return blocks


def dump_source(spark: SparkSession, path: str, split: int = SPLIT_BYTES) -> Source:
    """Tables of a plain dump in the types of the staging schema; the marks are looked for once.

    A table that the dump does not have, or a column that the schema does not, fails. Columns of the schema
    that the dump lacks are left out.
    """
    blocks = dump_blocks(spark, path, split)

    def read(table: str) -> DataFrame:
        if table not in blocks:
            raise LookupError(f"{path} holds no rows of {table}")
        names = list(dict.fromkeys(c for block in blocks[table] for c in block[3]))
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        return with_types(_read(spark, schema, split, blocks=blocks[table]), TABLES[table].schema, TABLES[table])

    return read


def write_dump(df: DataFrame, table: str, path: str, schema: str = "bookings") -> None:
    """Rows of a table as a folder of dump files, each with its own marks."""
    rows = to_landing(df, TABLES[table])

    def text(name: str):
        out = F.col(name).cast("string")
        for plain, written in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
            out = F.replace(out, F.lit(plain), F.lit(written))
        return F.coalesce(out, F.lit("\\N"))

    head = f"COPY {schema}.{table} ({', '.join(rows.columns)}) FROM stdin;"

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = lambda lines: pa.RecordBatch.from_arrays([lines], ["value"])
        yield made(pa.array([head]))
        for batch in batches:
            yield made(batch.column(0))
        yield made(pa.array(["\\."]))

    lines = rows.select(F.concat_ws("\t", *[text(c) for c in rows.columns]).alias("value"))
    lines.mapInArrow(marked, "value string").write.mode("overwrite").text(path)
