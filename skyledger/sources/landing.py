"""Landing zone: CSV and JSON folders between the source and the staging tables."""

import csv
import datetime as dt
import functools
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.clock import data_day
from skyledger.functions.values import POINT, canonical_json, json_document, point_from_text, point_to_text
from skyledger.schemas import Table

# Quotes are doubled, blanks kept and line breaks allowed inside quotes. A file with such
# breaks cannot be split, so files are kept short instead.
_FORMAT = {"header": "true", "escape": '"', "lineSep": "\n", "encoding": "UTF-8"}
_WRITE = {
    **_FORMAT,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# Files are grouped by header and read by name; one whose header changes in between fails.
_READ = {**_FORMAT, "multiLine": "true", "enforceSchema": "false"}
ROWS_PER_FILE = 1_000_000


def daily_root(root: str, table: str) -> str:
    return f"{root}/daily/{table}"


def landing_path(root: str, table: str, incremental: bool = False, ds: str | dt.date | None = None) -> str:
    """Folder of a full extract, or of the day before the run date `ds`."""
    if not incremental:
        return f"{root}/full/{table}"
    return f"{daily_root(root, table)}/dt={data_day(ds).isoformat()}"


def to_landing(df: DataFrame, table: Table) -> DataFrame:
    """Nested and JSON columns as text, ready for CSV.

    An empty document of a nullable JSON column counts as missing.
    """
    out = []
    for field in df.schema.fields:
        col: Column = F.col(field.name)
        if field.name in table.json:
            nullable = field.name not in table.required
            col = json_document(col, field.dataType, empty_is_null=nullable)
        elif field.dataType == POINT:
            col = point_to_text(col)
        elif isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            col = F.when(~F.isnan(col), col)
        out.append(col.alias(field.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, compression: str = "none") -> None:
    """One header in each file. Files cannot be split anyway, so `compression` costs no tasks when they are read."""
    options = {"maxRecordsPerFile": rows_per_file, "compression": compression}
    df.write.mode("overwrite").options(**_WRITE, **options).csv(path)


def drop_landing(spark: SparkSession, path: str) -> None:
    """Remove a landed folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _files(spark: SparkSession, path: str) -> list[str]:
    """The CSV files of a folder and of the day folders in it, or the one file."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s for pattern in (path, f"{path}/*", f"{path}/dt=*/*") for s in fs.globStatus(hadoop(pattern)) or []]
    hidden = lambda s: s.getPath().getName().startswith(("_", "."))
    return sorted(s.getPath().toString() for s in found if s.isFile() and s.getLen() and not hidden(s))


def _header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """The column names of a file, of which only the beginning is read."""
    at = spark._jvm.org.apache.hadoop.fs.Path(file)
    conf = spark._jsc.hadoopConfiguration()
    stream, codec = at.getFileSystem(conf).open(at), spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
    if codec is not None:
        stream = codec.createInputStream(stream)
    try:
        line = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    names = tuple(next(csv.reader([line])))
    if len(set(names)) < len(names):
        raise ValueError(f"{file} names a column twice: {names}")
    return names


def read_csv_files(spark: SparkSession, files: Iterable[str], day: bool = False) -> DataFrame:
    """Files of any column order, all columns as text and by name; a column a file lacks is NULL.

    One scan for each header there is. `day` adds the day of the folder dt=<day> a file is in.
    """
    files = list(files)
    with ThreadPoolExecutor(max_workers=16) as pool:
        headers = list(pool.map(lambda f: _header(spark, f), files))
    parts = []
    for names in sorted(set(headers)):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        part = spark.read.schema(schema).options(**_READ).csv([f for f, h in zip(files, headers) if h == names])
        if day:
            part = part.withColumn("dt", F.regexp_extract(F.col("_metadata.file_path"), r"/dt=(\d{4}-\d\d-\d\d)/", 1).cast("date"))
        parts.append(part)
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """The columns named in the headers, all as text; empty fields, quoted or not, are NULL."""
    return read_csv_files(spark, _files(spark, path) or [path])


def stream_landed_files(spark: SparkSession, path: str) -> DataFrame:
    """New CSV files under the dt= folders of `path`, by name; their content is not read."""
    listing = "path string, modificationTime timestamp, length bigint, content binary"
    files = spark.readStream.schema(listing).format("binaryFile").option("pathGlobFilter", "*.csv{,.gz}")
    return files.option("recursiveFileLookup", "true").load(path).where("length > 0").select("path")


def _typed(name: str, data_type: T.DataType, table: Table | None) -> Column:
    col = F.col(name)
    if data_type == POINT:
        return point_from_text(col)
    if table and name in table.json:
        return canonical_json(col)
    if table and name in table.codes:
        return F.rtrim(col)
    return col.cast(data_type)


def with_types(text: DataFrame, schema: T.StructType, table: Table | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Give text columns their types by name; text that does not fit fails the job.

    Columns may come in any order and some may be absent; none may be unknown. No type
    is guessed from the data, so codes keep their leading zeros.
    """
    types = {f.name: f.dataType for f in schema.fields}
    unknown = [c for c in text.columns if c not in types and c not in keep]
    if unknown:
        raise ValueError(f"columns {unknown} are not part of the schema")
    return text.select(*[_typed(c, types[c], table).alias(c) for c in text.columns if c in types], *keep)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, table: Table | None = None) -> DataFrame:
    return with_types(read_csv_text(spark, path), schema, table)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
