"""WARC archives as a Spark data source, written and read in Python.

Every record is a gzip member of its own with the lengths of the member in its header (subfield "sl"),
so a reader inflates the first part of a record, tests the record type and header fields there, and
moves on to the next member without touching the rest. Plain .warc files are passed over by their content
length; members without "sl" are inflated to find their end. Files are packed into partitions by size.

Paths go through pyarrow's file systems, so they can be in any store that these reach.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from skyledger.llm.common import stored

#: Columns of a record; all but the last two are headers.
SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, payload_digest string, refers_to string, "
    "payload_bytes bigint, headers map<string, string>, payload binary"
)
HEADERS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PARTITION_BYTES = 64 << 20
HEAD = 2048
#: The start of the names of the folders of writes, and the file in them that lists what is complete.
WRITE, MARK = "write-", "_complete"
END = b"\r\n\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path within it, for a URI or a local path."""
    if re.match(r"file:/(?!//)", path):
        path = "file:///" + path[6:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def record(kind: str, number, uri: str | None, date: str, payload: bytes | None, digest: str, size: int, refers) -> bytes:
    """One record as a gzip member; `payload` is None for a revisit, `size` is that of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}".encode() + END
    block = http + (payload or b"")
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{number}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", uri) if uri else None),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Refers-To", f"<urn:page:{refers}>" if kind == "revisit" else None),
        ("WARC-Profile", PROFILE if kind == "revisit" else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head if v is not None) + "\r\n"
    return member(text.encode() + block + END)


def member(data: bytes) -> bytes:
    """A gzip member that says its own length and that of its content."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    tail = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    length = 10 + 2 + 12 + len(body) + len(tail)
    extra = b"sl" + struct.pack("<HII", 8, length, len(data) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + tail


class Members:
    """Records of a compressed file: the start of each is inflated, the rest on demand."""

    def __init__(self, stream):
        self.stream, self.at = stream, 0

    def __iter__(self) -> Iterator[Members]:
        while True:
            self.stream.seek(self.at)
            start = self.stream.read(24)
            if not start:
                return
            if start[:3] != b"\x1f\x8b\x08":
                raise ValueError(f"no gzip member at byte {self.at}")
            self.length = None
            if start[3] & 4 and start[12:14] == b"sl":
                self.length = struct.unpack_from("<I", start, 16)[0]
            self.inflater = zlib.decompressobj(31)
            self.read = 0
            self.text = b""
            self._more(start, HEAD)
            while END not in self.text and not self.inflater.eof:
                if not self._more(self.inflater.unconsumed_tail or self.stream.read(HEAD), HEAD):
                    raise ValueError("a record without an end of its header")
            yield self
            if self.length is None:
                self.rest()
                self.length = self.read - len(self.inflater.unused_data)
            self.at += self.length

    def _more(self, data: bytes, most: int = 0) -> bool:
        fresh = data is not self.inflater.unconsumed_tail
        self.read += len(data) if fresh else 0
        self.text += self.inflater.decompress(data, most)
        return bool(data)

    def rest(self) -> bytes:
        """The whole record, inflated to its end."""
        parts = [self.text]
        while not self.inflater.eof:
            tail = self.inflater.unconsumed_tail
            data = tail or self.stream.read(1 << 16)
            if not data:
                raise ValueError("a gzip member that ends too early")
            self.read += 0 if tail else len(data)
            parts.append(self.inflater.decompress(data))
        self.text = b"".join(parts)
        return self.text


class Plain:
    """Records of an uncompressed file, passed over by their content length."""

    def __init__(self, stream):
        self.stream = stream

    def __iter__(self) -> Iterator[Plain]:
        at = 0
        while True:
            self.stream.seek(at)
            self.text = b""
            while END not in self.text:
                data = self.stream.read(HEAD)
                if not data:
                    if self.text.strip():
                        raise ValueError("a record without an end of its header")
                    return
                self.text += data
            head = self.text.index(END) + 4
            size = int(parse_headers(self.text[:head]).get("content-length", 0))
            self.at, self.end = at, at + head + size
            yield self
            at = self.end + 4

    def rest(self) -> bytes:
        self.stream.seek(self.at)
        return self.stream.read(self.end - self.at) + END


def parse_headers(head: bytes) -> dict[str, str]:
    """Header fields with names in lower case; lines that continue a field are joined to it."""
    lines = re.sub(rb"\r\n[ \t]+", b" ", head).decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, sep, v in (x.partition(":") for x in lines[1:]) if sep}


@dataclass
class Test:
    """A header field, and the values it may have or the start it must have."""

    name: str
    values: tuple | None = None
    start: str | None = None

    def passes(self, headers: dict[str, str]) -> bool:
        value = headers.get(HEADERS[self.name])
        if value is None:
            return False
        return value in self.values if self.values is not None else value.startswith(self.start)


def committed(store: pafs.FileSystem, found: list[pafs.FileInfo]) -> Callable[[str], bool]:
    """Which files may be read: in the folder of a write those that its mark lists, elsewhere all."""
    listed = set()
    for f in found:
        if f.path.endswith(f"/{MARK}"):
            with store.open_input_stream(f.path) as stream:
                listed |= {f"{f.path[: -len(MARK)]}{name}" for name in json.loads(stream.read())}
    return lambda path: path in listed or not path.rsplit("/", 2)[-2].startswith(WRITE)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, names: list[str]):
        self.path, self.names = options["path"], names
        self.verify = options.get("verify", "false").lower() == "true"
        given = json.loads(options.get("tests", "{}"))
        self.tests = [Test(n, start=v[:-1]) if isinstance(v, str) else Test(n, values=tuple(v)) for n, v in given.items()]

    def partitions(self) -> list[InputPartition]:
        """Files packed by size, the largest first; a file is read by one task."""
        store, path = open_store(self.path)
        found = store.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True))
        whole = committed(store, found)
        files = sorted(
            (f for f in found if re.search(r"\.warc(\.gz)?$", f.path) and "/_" not in f.path[len(path) :] and whole(f.path)),
            key=lambda f: (-f.size, f.path),
        )
        out, room = [], 0
        for f in files:
            if not out or room < f.size:
                out.append([])
                room = PARTITION_BYTES
            out[-1].append(f.path)
            room -= f.size
        return [InputPartition(paths) for paths in out or [[]]]

    def read(self, partition: InputPartition):
        store, _ = open_store(self.path)
        for path in partition.value:
            with store.open_input_file(path) as stream:
                gz = stream.read(2) == b"\x1f\x8b"
                for found in (Members if gz else Plain)(stream):
                    head, _, begun = found.text.partition(END)
                    headers = parse_headers(head)
                    if all(t.passes(headers) for t in self.tests):
                        yield self.row(headers, head, begun, found)

    def row(self, headers: dict[str, str], head: bytes, begun: bytes, found) -> tuple:
        """The columns asked for; the payload is inflated only if it is one of them or is verified."""
        values = {c: headers.get(h) for c, h in HEADERS.items()}
        is_http = headers.get("content-type", "").startswith("application/http")
        wanted = "payload" in self.names or (self.verify and values["record_type"] == "response")
        if wanted or (is_http and END not in begun):
            begun = found.rest()[len(head) + 4 :]
        size, block = int(headers.get("content-length", 0)), begun
        values["payload_bytes"] = size
        if is_http:
            http, _, block = begun.partition(END)
            inner = parse_headers(http + b"\r\n")
            values["payload_bytes"] = int(inner.get("content-length", size - len(http) - 4))
        if wanted:
            payload = block[: size - (len(begun) - len(block))]
            values["payload"] = None if values["record_type"] == "revisit" else payload
            digest = values["payload_digest"]
            if self.verify and values["record_type"] == "response" and digest and digest != f"sha1:{base32_sha1(payload)}":
                raise ValueError(f"the payload of {values['record_id']} does not have its digest")
        values["headers"] = headers
        return tuple(values.get(n) for n in self.names)


@dataclass
class Written(WriterCommitMessage):
    path: str | None


class WarcWriter(DataSourceArrowWriter):
    """Each task writes a file of its own in the folder of the write; the commit lists those of tasks that ended.

    The list is one file, written last, so readers see all of a write or nothing.
    """

    def __init__(self, options: dict):
        self.path, self.date = options["path"], options.get("date", "1970-01-01T00:00:00Z")
        self.folder = f"{WRITE}{uuid.uuid4().hex}"

    def write(self, iterator) -> Written:
        store, root = open_store(self.path)
        name, stream = f"{uuid.uuid4().hex}.warc.gz", None
        for batch in iterator:
            for low in range(0, batch.num_rows, 256):
                for r in batch.slice(low, 256).to_pylist():
                    if stream is None:
                        store.create_dir(f"{root}/{self.folder}", recursive=True)
                        stream = store.open_output_stream(f"{root}/{self.folder}/{name}", compression=None)
                    payload, kind = (r["payload"] or "").encode(), "response" if r["refers_to"] is None else "revisit"
                    full = payload if kind == "response" else None
                    stream.write(
                        record(kind, r["page_id"], r["url"], self.date, full, base32_sha1(payload), len(payload), r["refers_to"])
                    )
        if stream is not None:
            stream.close()
        return Written(name if stream is not None else None)

    def commit(self, messages) -> None:
        store, root = open_store(self.path)
        names = [m.path for m in messages if m is not None and m.path]
        if names:
            with store.open_output_stream(f"{root}/{self.folder}/{MARK}", compression=None) as stream:
                stream.write(json.dumps(names).encode())

    def abort(self, messages) -> None:
        store, root = open_store(self.path)
        if store.get_file_info(f"{root}/{self.folder}").type != pafs.FileType.NotFound:
            store.delete_dir(f"{root}/{self.folder}")


class WarcSource(DataSource):
    """format("warc"): options path, tests and verify (read), date (write). A schema without payload skips payloads."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options), schema.names)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options))


def read_warc(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    tests: dict[str, list[str] | str] | None = None,
    verify: bool = False,
) -> DataFrame:
    """Records of the archives below `path`; `columns` are some of SCHEMA, all if not given.

    `tests` go down to the source and are decided on the headers: for a header column the values it may
    have, or a text with * at its end for what it must start with. They belong to the load and not to a
    later filter, because Spark 4.1 keeps the filters pushed into a Python source for all plans over it.
    """
    for name, test in (tests or {}).items():
        if name not in HEADERS or (isinstance(test, str) and not test.endswith("*")):
            raise ValueError(f"no test of a header: {name} {test!r}")
    spark.dataSource.register(WarcSource)
    types = dict(c.split(" ", 1) for c in re.split(r", (?=\w+ )", SCHEMA))
    schema = ", ".join(f"{n} {types[n]}" for n in columns or types)
    options = {"verify": str(verify).lower(), "tests": json.dumps(tests or {})}
    return spark.read.format("warc").schema(schema).options(**options).load(path)


def mark_revisits(pages: DataFrame, least: int = 0, page: str = "html") -> DataFrame:
    """page_id, url, payload and refers_to: the largest page_id of equal payloads of at least `least` bytes.

    refers_to is null for that record itself and for smaller payloads. A null page is an empty payload.
    Records that share the largest id are all kept whole, as are records without an id.
    """
    payload = F.coalesce(F.col(page), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("_digest", F.unhex(F.sha1(F.encode("payload", "UTF-8"))))
    long = rows.where(F.octet_length("payload") >= least)
    groups = long.groupBy("_digest").agg(F.max("page_id").alias("_largest"), F.count("*").alias("_n")).where("_n > 1")
    # Stored, so that the join is of two plain sides and a payload with very many copies can be split.
    groups = stored(groups.drop("_n"), "payload_groups")
    refers = F.when(F.col("page_id") < F.col("_largest"), F.col("_largest"))
    return rows.join(groups, "_digest", "left").select("page_id", "url", "payload", refers.alias("refers_to"))


def write_pages(pages: DataFrame, path: str, least: int = 0, date: str = "1970-01-01T00:00:00Z", page: str = "html") -> None:
    """Write a record for each page, copies as revisits; a file for each task with rows."""
    pages.sparkSession.dataSource.register(WarcSource)
    mark_revisits(pages, least, page).write.format("warc").option("date", date).mode("append").save(path)


def page_number(column: str) -> Column:
    """The page_id in a record id; null if it holds none."""
    return F.regexp_extract(F.col(column), "<urn:page:(-?[0-9]+)>", 1).try_cast("bigint")
