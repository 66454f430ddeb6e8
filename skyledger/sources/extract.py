"""Where staging rows come from: whole tables, or the rows touched on one day."""

import datetime as dt
import decimal
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.clock import data_day, on_day

Source = Callable[[str], DataFrame]


def parquet_source(spark: SparkSession, root: str, suffix: str = "") -> Source:
    return lambda table: spark.read.parquet(f"{root}/{table}{suffix}")


def table_source(spark: SparkSession, database: str) -> Source:
    return lambda table: spark.table(f"{database}.{table}")


def jdbc_options(
    url: str,
    table: str,
    partition: Mapping[str, object] | None = None,
    fetch_size: int = 10_000,
    **properties: str,
) -> dict[str, str]:
    """Options of a JDBC scan.

    `partition` holds column, lower, upper and count, and splits the scan into `count`
    ranges of a numeric, date or timestamp column; without it one task reads the table.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **properties}
    if partition:
        options.update(
            partitionColumn=str(partition["column"]),
            lowerBound=str(partition["lower"]),
            upperBound=str(partition["upper"]),
            numPartitions=str(partition["count"]),
        )
    return options


def _literal(value) -> str:
    """A key value as SQL that any database reads as the same value."""
    if isinstance(value, (bool, int, decimal.Decimal)):
        return str(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    raise ValueError(f"keys of type {type(value).__name__} cannot be split into ranges")


def plan_splits(last: DataFrame, key: str, count: int, collation: str | None = '"C"') -> list[str]:
    """At most `count` predicates, each for about as many rows of `last`, that together cover any value of `key` once.

    `last` is what is known of the table, for example its last extract; the table may have changed since,
    which makes ranges uneven but leaves out nothing. Bounds are quantiles that Spark's range partitioning
    estimates from a sample of keys. They are in order of bytes, so text is compared under `collation`,
    by default that of PostgreSQL for bytes; NULL goes with the lowest range. Keys have to be whole or
    decimal numbers, dates, timestamps or text.
    """
    ranges = last.select(F.col(key).alias("key")).where("key IS NOT NULL").repartitionByRange(count, "key")
    lows = ranges.groupBy(F.spark_partition_id()).agg(F.min("key").alias("low")).select("low").distinct()
    bounds = sorted(r["low"] for r in lows.collect())[1:]  # no more than `count`
    text = f"{key} COLLATE {collation}" if collation and any(isinstance(b, str) for b in bounds) else key
    if not bounds:
        return [f"{key} IS NULL OR {key} IS NOT NULL"]
    written = [_literal(b) for b in bounds]
    middle = [f"{text} >= {a} AND {text} < {b}" for a, b in zip(written, written[1:])]
    return [f"{text} < {written[0]} OR {key} IS NULL", *middle, f"{text} >= {written[-1]}"]


def jdbc_source(
    spark: SparkSession,
    url: str,
    schema: str,
    partitions: Mapping[str, Mapping[str, object]] | None = None,
    predicates: Mapping[str, Sequence[str]] | None = None,
    single: bool | Sequence[str] = False,
    **properties: str,
) -> Source:
    """Tables of a database schema; filters and columns are sent to the database.

    Per table, either `partitions` (see `jdbc_options`) or `predicates`, one WHERE clause
    per task, which suits text keys. The predicates of a table must cover it once; `plan_splits`
    makes such. A table with neither is refused, as one task would read it, unless it is in
    `single`, or `single` is true.
    """

    def read(table: str) -> DataFrame:
        name = f"{schema}.{table}"
        if predicates and table in predicates:
            return spark.read.jdbc(url, name, predicates=list(predicates[table]), properties=properties)
        if table not in (partitions or {}) and single is not True and table not in (single or ()):
            raise ValueError(f"{table} would be read by one task; give partitions or predicates, or name it in `single`")
        options = jdbc_options(url, name, (partitions or {}).get(table), **properties)
        return spark.read.format("jdbc").options(**options).load()

    return read


def touched_on(df: DataFrame, day: dt.date) -> DataFrame:
    """Rows created or updated on `day`."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    created, updated = (
        on_day(F.col(c), day, types[c]) for c in ("created_at", "updated_at")
    )
    return df.where(created | updated)


def extract(source: Source, table: str, incremental: bool = False, ds: str | dt.date | None = None) -> DataFrame:
    """All rows of `table`, or those touched on the day before the run date `ds`."""
    df = source(table)
    if not incremental:
        return df
    if ds is None:
        raise ValueError("an incremental extract needs the run date ds")
    return touched_on(df, data_day(ds))
