"""Type-2 history by comparing a query result with the open versions of a table."""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.values import any_differs, key_text
from skyledger.operators.joins import one_row_per_key

SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO = (
    "dbt_scd_id",
    "dbt_updated_at",
    "dbt_valid_from",
    "dbt_valid_to",
)
VERSION_COLUMNS = (SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO)


def _run_time(run_ts: dt.datetime) -> Column:
    return F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def history_schema(schema: T.StructType) -> T.StructType:
    """`schema` with the four version columns behind it."""
    moments = [T.StructField(c, T.TimestampNTZType()) for c in (UPDATED_AT, VALID_FROM, VALID_TO)]
    fields = [T.StructField(f.name, f.dataType) for f in schema.fields]
    return T.StructType([*fields, T.StructField(SCD_ID, T.StringType()), *moments])


def first_versions(new: DataFrame, keys: Sequence[str], run_ts: dt.datetime) -> DataFrame:
    """Every row of `new` as an open version that starts at `run_ts`."""
    at = _run_time(run_ts)
    return new.select(
        "*",
        F.md5(key_text(*[F.col(k) for k in keys], at)).alias(SCD_ID),
        at.alias(UPDATED_AT),
        at.alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
    )


def open_versions(history: DataFrame) -> DataFrame:
    return history.where(F.col(VALID_TO).isNull())


def closed_versions(history: DataFrame) -> DataFrame:
    return history.where(F.col(VALID_TO).isNotNull())


def _require_same_types(open_rows: DataFrame, new: DataFrame) -> None:
    have = {f.name: f.dataType for f in open_rows.schema.fields if f.name not in VERSION_COLUMNS}
    want = {f.name: f.dataType for f in new.schema.fields}
    if have != want:
        raise ValueError(f"history columns {have} do not match the new rows {want}")


def snapshot_step(
    open_rows: DataFrame | None,
    new: DataFrame,
    keys: Sequence[str],
    run_ts: dt.datetime,
    check_cols: Sequence[str] | None = None,
    on_duplicates: str = "error",
    order_by: str = "updated_at",
    changes_only: bool = False,
) -> DataFrame:
    """The versions that one run leaves open, and those it closes (valid_to = `run_ts`).

    With `changes_only` the open versions that stay as they were are left out.

    Closed versions of earlier runs play no part, so the work depends on the number of
    current rows and not on the length of the history. A key only in `new` is inserted,
    a key only in `open_rows` stays open, a key in both gets a new version when any
    check column is distinct. Both sides are hashed by key once. Keys are unique on
    both sides, so no key can be hot.
    """
    keys = list(keys)
    rest = [c for c in new.columns if c not in keys]
    check_cols = list(check_cols) if check_cols is not None else rest
    new = one_row_per_key(new, keys, "snapshot", on_duplicates, order_by)
    if open_rows is None:
        return first_versions(new, keys, run_ts)
    _require_same_types(open_rows, new)

    at = _run_time(run_ts)
    before = open_rows.select(*keys, F.struct(*rest, *VERSION_COLUMNS).alias("_old"))
    after = new.select(*keys, F.struct(*(rest or [F.lit(True)])).alias("_new"))
    old, fresh = F.col("_old"), F.col("_new")
    in_both = old.isNotNull() & fresh.isNotNull()
    changed = in_both & any_differs((old[c], fresh[c]) for c in check_cols)

    old_version = F.struct(
        *[old[c].alias(c) for c in rest],
        *[old[c].alias(c) for c in (SCD_ID, UPDATED_AT, VALID_FROM)],
        F.when(F.col("_changed"), at).alias(VALID_TO),
    )
    new_version = F.struct(
        *[fresh[c].alias(c) for c in rest],
        F.md5(key_text(*[F.col(k) for k in keys], at)).alias(SCD_ID),
        at.alias(UPDATED_AT),
        at.alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
    )
    versions = F.array(
        F.when(F.col("_changed") if changes_only else old.isNotNull(), old_version),
        F.when(old.isNull() | F.col("_changed"), new_version),
    )
    # One join feeds both versions of a row; three filters of it would run it three times.
    # The empty slot is filtered after the explode, which keeps all of it in generated code.
    return (
        before.join(after, keys, "full_outer")
        .withColumn("_changed", changed)
        .select(*keys, F.explode(versions).alias("_v"))
        .where(F.col("_v").isNotNull())
        .select(*[F.col(c) if c in keys else F.col("_v")[c].alias(c) for c in [*new.columns, *VERSION_COLUMNS]])
    )


def snapshot_changes(
    open_rows: DataFrame | None,
    new: DataFrame,
    keys: Sequence[str],
    run_ts: dt.datetime,
    check_cols: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Only the versions that one run opens or closes; a run without changes has none."""
    return snapshot_step(open_rows, new, keys, run_ts, check_cols, changes_only=True, **options)


def snapshot_check(
    history: DataFrame | None,
    new: DataFrame,
    keys: Sequence[str],
    run_ts: dt.datetime,
    check_cols: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """The whole history after a run: earlier closed versions and the result of `snapshot_step`."""
    if history is None:
        return snapshot_step(None, new, keys, run_ts, check_cols, **options)
    step = snapshot_step(open_versions(history), new, keys, run_ts, check_cols, **options)
    return closed_versions(history).select(step.columns).unionByName(step)


def visible_versions(dim: DataFrame, versions: str = "all") -> DataFrame:
    """Dimension rows that facts join: every version, or only the open one of each key.

    `as_of` is for places, which flights look up at their departure; elsewhere it means the open one.
    """
    if versions == "all" or VALID_TO not in dim.columns:
        return dim
    if versions in ("current", "as_of"):
        return open_versions(dim)
    raise ValueError(f"versions is 'all', 'current' or 'as_of', not {versions!r}")
