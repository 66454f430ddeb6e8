"""Daily staging: extract every table to the landing zone, then upsert it."""

import datetime as dt
import math
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.clock import parse_day
from skyledger.functions.values import stable_id
from skyledger.operators import keyindex
from skyledger.operators.quality import batch_violations, enforce
from skyledger.operators.upsert import first_rows, upsert
from skyledger.schemas import LOAD_ORDER, TABLES, Table
from skyledger.session import scratch_path
from skyledger.sources.extract import Source, extract
from skyledger.sources.landing import drop_landing, landing_path, read_csv, to_landing, write_csv
from skyledger.sources.store import BUCKET, Store, Version, bucket_number

STATUS_SCHEMA = "`table` string, step string, status string, data_date date, `rows` bigint, run_ts timestamp_ntz"
SUCCESS, SKIPPED, FAILED = "success", "skipped", "failed"
#: Not loaded, since a table it refers to failed in the same run.
BLOCKED = "blocked"
#: The part of a bucket that a task has its rows of, by number; and the Parquet bytes meant for a task.
PART, TASK_BYTES = "store_part", 16 << 20
PROFILE_SCHEMA = (
    "`table` string, data_date date, run_ts timestamp_ntz, `column` string, `rows` bigint, nulls bigint, "
    "distinct_values bigint, low string, high string"
)


def _status(table: str, step: str, status: str, ds, run_ts, rows: int | None = None) -> tuple:
    return table, step, status, parse_day(ds), rows, run_ts


def status_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, STATUS_SCHEMA)


def _status_path(store: Store) -> str:
    return store.path("stg.run_status")


def record_status(store: Store, rows: list[tuple]) -> DataFrame:
    """Append one row per table and step to the status table."""
    frame = status_frame(store.spark, rows)
    frame.coalesce(1).write.mode("append").parquet(_status_path(store))
    return frame


def run_status(store: Store) -> DataFrame:
    return store.spark.read.schema(STATUS_SCHEMA).parquet(_status_path(store))


def last_extract(store: Store, table: str, ds: str | dt.date) -> tuple[str, int | None] | None:
    """Status and row count of the table's last extract for `ds`, if there was one."""
    found = (
        run_status(store)
        .where((F.col("table") == table) & (F.col("step") == "extract") & (F.col("data_date") == F.lit(parse_day(ds))))
        .agg(F.max_by(F.struct("status", "rows"), "run_ts").alias("last"))
        .first()["last"]
    )
    return (found["status"], found["rows"]) if found else None


def _measures(df: DataFrame) -> list[Column]:
    """Rows, and for each column NULLs, distinct values (by a sketch), least and largest value as text."""
    out = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(df.columns):
        col = F.col(f"`{c}`")
        out += [
            F.count_if(col.isNull()).alias(f"nulls_{i}"),
            F.approx_count_distinct(col).alias(f"distinct_{i}"),
            F.min(col).cast("string").alias(f"low_{i}"),
            F.max(col).cast("string").alias(f"high_{i}"),
        ]
    return out


def _profile_path(store: Store) -> str:
    return store.path("stg.load_profile")


def load_profile(store: Store) -> DataFrame:
    """What each extract's one pass saw: a row for each run, table and column."""
    return store.spark.read.schema(PROFILE_SCHEMA).parquet(_profile_path(store))


def record_profiles(store: Store, rows: list[tuple]) -> None:
    if rows:
        store.spark.createDataFrame(rows, PROFILE_SCHEMA).coalesce(1).write.mode("append").parquet(_profile_path(store))


def extract_table(
    source: Source,
    table: Table,
    landing: str,
    ds: str | dt.date,
    run_ts: dt.datetime,
    incremental: bool = False,
    profiles: list | None = None,
) -> tuple:
    """Write one extract as CSV; of an empty one no folder stays.

    The source is read once: the count comes with the write, and with `profiles`, to which they are
    added, the measures of all columns.
    """
    rows, path = to_landing(extract(source, table.name, incremental, ds), table), landing_path(landing, table.name, incremental, ds)
    seen = Observation()
    measures = _measures(rows) if profiles is not None else [F.count(F.lit(1)).alias("rows")]
    write_csv(rows.observe(seen, *measures), path, compression="gzip")
    got = seen.get
    if not got["rows"]:
        drop_landing(rows.sparkSession, path)
        return _status(table.name, "extract", SKIPPED, ds, run_ts, 0)
    if profiles is not None:
        profiles += [
            (table.name, parse_day(ds), run_ts, c, got["rows"], *(got[f"{m}_{i}"] for m in ("nulls", "distinct", "low", "high")))
            for i, c in enumerate(rows.columns)
        ]
    return _status(table.name, "extract", SUCCESS, ds, run_ts, got["rows"])


def extract_tables(
    source: Source,
    landing: str,
    ds: str | dt.date,
    run_ts: dt.datetime,
    incremental: bool = False,
    tables: Iterable[str] = tuple(TABLES),
    profiles: list | None = None,
    failures: list | None = None,
) -> list[tuple]:
    """Extract all tables; they do not depend on each other, so their jobs overlap.

    With `failures` a table that fails is added to them, has the status `failed`, and does not stop others.
    """

    def one(table: Table) -> tuple:
        run = lambda: extract_table(source, table, landing, ds, run_ts, incremental, profiles)
        return _guarded(run, table, "extract", ds, run_ts, failures)

    chosen = [TABLES[name] for name in tables]
    with ThreadPoolExecutor(max_workers=len(chosen)) as pool:
        return list(pool.map(one, chosen))


def _guarded(run, table: Table, step: str, ds, run_ts, failures: list | None) -> tuple:
    if failures is None:
        return run()
    try:
        return run()
    except Exception as error:  # whatever it is, it is recorded and raised when the other tables are done
        failures.append((table.name, step, error))
        return _status(table.name, step, FAILED, ds, run_ts)


def insert_defaults(table: Table, run_ts: dt.datetime) -> dict:
    """What a new row gets in columns its batch does not have."""
    now = F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return {"id": stable_id(table.name, *[F.col(k) for k in table.key]), "created_at": now, "updated_at": now}


def _staged(spark: SparkSession, df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """The rows written to `path`, so that what they come from is computed once, and their number."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get["rows"]


def _in_bucket(df: DataFrame, schema: T.StructType, columns: Sequence[str], buckets: int) -> DataFrame:
    """The rows with their bucket, which also decides the task that they go to."""
    keys = [F.col(c).cast(schema[c].dataType) for c in columns]
    return df.withColumn(BUCKET, bucket_number(keys, buckets))


def _by_bucket(df: DataFrame, schema: T.StructType, columns: Sequence[str], parts: int = 1) -> DataFrame:
    """The rows with their part in PART; those of one bucket and part meet in one task."""
    keys = [F.col(c).cast(schema[c].dataType) for c in columns]
    return df.withColumn(PART, F.pmod(F.hash(*keys), F.lit(parts))).repartition(BUCKET, PART)


def _numbers(df: DataFrame) -> list[int]:
    """The buckets that rows are in; no more than the table has."""
    return sorted(r[0] for r in df.select(BUCKET).distinct().collect())


def _with_bucket(schema: T.StructType, *more: str) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(c, T.IntegerType()) for c in (BUCKET, *more))])


def task_parts(total: int, buckets: int) -> int:
    """In how many parts a bucket is dealt to tasks, given the bytes of the rows; each becomes a file of the bucket."""
    return max(1, math.ceil(total / buckets / TASK_BYTES))


def index_name(columns: Sequence[str]) -> str:
    return "-".join(columns)


def rebucket(store: Store, table: Table, buckets: int) -> None:
    """Rewrite stg.<table> and its key indexes in another number of buckets; a table as a whole becomes one in buckets."""
    rows, version = store.read(f"stg.{table.name}"), store.begin(f"stg.{table.name}")
    parts = task_parts(store.folder_bytes(store.path(f"stg.{table.name}")), buckets)
    written = [(None, rows, table.key)]
    written += [(index_name(c), keyindex.entries(rows, c, table.key), c) for c in table.unique]
    for name, part, columns in written:
        part = _by_bucket(_in_bucket(part, table.schema, columns, buckets), table.schema, columns, parts)
        version.write_buckets(part.drop(PART), buckets, name)
    version.commit()


def _index_after(store: Store, version: Version, table: Table, columns, before, after, batch, buckets, parts, path) -> DataFrame:
    """Write the index of unique columns after a batch, as part of the version; returns the clashes.

    The clashes are read from `path`, where the entries that change are kept.
    """
    spark, name = store.spark, index_name(columns)
    changes = keyindex.changed_entries(before, after, batch, columns, table.key)
    changes, n = _staged(spark, _in_bucket(changes, table.schema, columns, buckets), path)
    schema = changes.drop(keyindex.COME).schema
    if not n:
        return spark.createDataFrame([], schema).select(*columns, F.lit(0).cast("bigint").alias("rows"))
    chosen = _numbers(changes)
    known = store.read_buckets(version.table, chosen, name)
    now = _by_bucket(keyindex.after_changes(known, changes), schema, columns, parts).drop(PART)
    version.write_buckets(now, buckets, name, chosen)
    return keyindex.clashes(version.read_buckets(buckets, schema, name), changes, columns)


def upsert_table(
    store: Store,
    table: Table,
    batch: DataFrame,
    run_ts: dt.datetime,
    on_duplicates: str = "error",
    rules: bool = True,
    order_by: str = "updated_at",
    keep_newer: bool = False,
) -> int:
    """Upsert a batch into stg.<table>; returns the number of its rows.

    The table and an index for each further unique key are kept in key buckets. Only the buckets that the
    batch has keys of are read and written, and count once all of them and the indexes are. The batch
    itself is computed once. With `rules` a batch that breaks a rule of the table fails and leaves it as
    it was. An empty batch writes nothing.
    """
    name, defaults = f"stg.{table.name}", insert_defaults(table, run_ts)
    path = scratch_path(store.spark, "batch")
    batch, n = _staged(store.spark, batch, path)
    if not n:
        return 0
    first = not store.exists(name)
    if first:
        buckets = store.wanted_buckets(store.folder_bytes(path))
    else:
        buckets = store.buckets(name)
        wanted = store.crowded(name) if buckets else store.wanted_buckets(store.folder_bytes(store.path(name)))
        if wanted:
            rebucket(store, table, wanted)
            buckets = wanted
    parts = task_parts(store.folder_bytes(path) + (0 if first else store.live_bytes(name)), buckets)
    batch = _in_bucket(batch, table.schema, table.key, buckets)
    before = None if first else store.read_buckets(name, _numbers(batch))
    keys, schema = [BUCKET, PART, *table.key], _with_bucket(table.schema)
    dealt = lambda rows: _by_bucket(rows, table.schema, table.key, parts)
    if before is None:
        after = first_rows(dealt(batch), _with_bucket(table.schema, PART), keys, defaults, on_duplicates, order_by)
    else:
        after = upsert(dealt(before), dealt(batch), keys, defaults, on_duplicates, order_by, keep_newer)
    version = store.begin(name)
    version.write_buckets(after.drop(PART), buckets)
    written = version.read_buckets(buckets, schema)
    # Of a first batch every row is in the table, and all rows of the table are the batch's.
    touched = None if first else batch
    entries = {c: scratch_path(store.spark, "entries") for c in table.unique}
    clashes = {c: _index_after(store, version, table, c, before, written, touched, buckets, parts, at) for c, at in entries.items()}
    if rules:
        parents = {ref.parent: store.read(f"stg.{ref.parent}") for ref in table.references}
        enforce(batch_violations(table, written, touched, parents, clashes))
    version.commit()
    for at in (path, *entries.values()):  # the batch is in the table now, its entries are in the indexes
        drop_landing(store.spark, at)
    return n


def load_table(
    store: Store,
    table: Table,
    landing: str,
    ds: str | dt.date,
    run_ts: dt.datetime,
    incremental: bool = False,
    on_duplicates: str = "error",
    rules: bool = True,
) -> tuple:
    """Upsert a landed extract. Without a successful extract for `ds` nothing is read or written."""
    last = last_extract(store, table.name, ds)
    if last is None or last[0] != SUCCESS:
        return _status(table.name, "load", SKIPPED, ds, run_ts, 0)
    batch = read_csv(store.spark, landing_path(landing, table.name, incremental, ds), table.schema, table)
    if not upsert_table(store, table, batch, run_ts, on_duplicates, rules):
        return _status(table.name, "load", SKIPPED, ds, run_ts, 0)
    return _status(table.name, "load", SUCCESS, ds, run_ts, last[1])


def load_waves(tables: Iterable[str]) -> list[list[Table]]:
    """The tables in waves: one refers only to tables of earlier waves, or to tables that are not chosen."""
    chosen, waves, done = [t for t in LOAD_ORDER if t.name in set(tables)], [], set()
    names = {t.name for t in chosen}
    while len(done) < len(chosen):
        wave = [t for t in chosen if t.name not in done and all(r.parent in done or r.parent not in names for r in t.references)]
        waves.append(wave)
        done |= {t.name for t in wave}
    return waves


def run_staging(
    store: Store,
    source: Source,
    landing: str,
    ds: str | dt.date,
    run_ts: dt.datetime,
    incremental: bool = False,
    tables: Iterable[str] = tuple(TABLES),
    on_duplicates: str = "error",
    rules: bool = True,
    on_failure: str = "raise",
) -> DataFrame:
    """One daily run; returns the status of every table and step.

    Loads go in waves, so that parents precede the tables that refer to them; the loads of a wave overlap.
    A table that fails is recorded as `failed`; tables that refer to it are `blocked`, all others are
    loaded. Then the first failure is raised, unless `on_failure` is "record".
    """
    if on_failure not in ("raise", "record"):
        raise ValueError(f"on_failure is 'raise' or 'record', not {on_failure!r}")
    tables, profiles, failures = tuple(tables), [], []
    statuses = extract_tables(source, landing, ds, run_ts, incremental, tables, profiles, failures)
    record_status(store, statuses)
    record_profiles(store, profiles)
    for wave in load_waves(tables):
        blocked = {name for name, _, _ in failures} | {s[0] for s in statuses if s[1] == "load" and s[2] == BLOCKED}

        def one(table: Table) -> tuple:
            if any(ref.parent in blocked for ref in table.references):
                return _status(table.name, "load", BLOCKED, ds, run_ts, 0)
            run = lambda: load_table(store, table, landing, ds, run_ts, incremental, on_duplicates, rules)
            return _guarded(run, table, "load", ds, run_ts, failures)

        with ThreadPoolExecutor(max_workers=len(wave)) as pool:
            loads = list(pool.map(one, wave))
        record_status(store, loads)
        statuses = [*statuses, *loads]
    if failures and on_failure == "raise":
        raise failures[0][2]
    return status_frame(store.spark, statuses)


def staging_frames(store: Store) -> dict[str, DataFrame]:
    """All staging tables; one that no load has written yet has no rows."""
    return {
        name: store.read(f"stg.{name}") if store.exists(f"stg.{name}") else store.spark.createDataFrame([], table.schema)
        for name, table in TABLES.items()
    }
