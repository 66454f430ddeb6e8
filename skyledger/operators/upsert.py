"""Keyed insert-or-update of a batch into a table."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.operators.joins import one_row_per_key


def first_rows(
    batch: DataFrame,
    schema: T.StructType,
    keys: Sequence[str],
    defaults: Mapping[str, Column] | None = None,
    on_duplicates: str = "error",
    order_by: str = "updated_at",
) -> DataFrame:
    """A table that does not exist yet, after its first batch: every row is an insert."""
    types = {f.name: f.dataType for f in schema.fields}
    batch = _checked(batch, types, keys)
    batch = one_row_per_key(batch, keys, "upsert", on_duplicates, order_by)
    defaults = {name: value.cast(types[name]) for name, value in (defaults or {}).items()}
    return batch.select(*[_inserted(c, batch, defaults, types[c]) for c in types])


def _checked(batch: DataFrame, types: Mapping[str, T.DataType], keys: Sequence[str]) -> DataFrame:
    """The batch in the types of the table; every key present, no column unknown."""
    unknown = [c for c in batch.columns if c not in types]
    missing = [k for k in keys if k not in batch.columns]
    if unknown or missing:
        raise ValueError(f"batch has unknown columns {unknown} or lacks keys {missing}")
    return batch.select(*[F.col(c).cast(types[c]).alias(c) for c in batch.columns])


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    defaults: Mapping[str, Column] | None = None,
    on_duplicates: str = "error",
    order_by: str = "updated_at",
    keep_newer: bool = False,
) -> DataFrame:
    """`target` after `batch`: new keys are inserted, known keys take the batch's columns.

    A NULL in the batch overwrites. Columns the batch does not have keep their value on
    update and take `defaults` (or NULL) on insert, so a generated id stays the same.
    With `keep_newer` a known row whose `order_by` is later than the batch's stays as it is, if both
    have that column and neither value is NULL.

    One full outer join on the key, whatever the sizes. Where only part of a table can be
    concerned, `target` should be that part: `plans.staging` gives the buckets of the batch.
    """
    keys = list(keys)
    types = {f.name: f.dataType for f in target.schema.fields}
    batch = _checked(batch, types, keys)
    batch = one_row_per_key(batch, keys, "upsert", on_duplicates, order_by)
    defaults = {name: value.cast(types[name]) for name, value in (defaults or {}).items()}
    dated = order_by if keep_newer and order_by in batch.columns and order_by not in keys else None
    return _merged(target, batch, keys, defaults, dated)


def _packed(batch: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in batch.columns if c not in keys]
    payload = F.struct(*rest) if rest else F.struct(F.lit(True).alias("present"))
    return batch.select(*keys, payload.alias("_new"))


def _updated(column: str, batch: DataFrame, keys: list[str], otherwise: Column) -> Column:
    if column in keys:
        return F.col(column)
    if column in batch.columns:
        return F.when(F.col("_new").isNotNull(), F.col("_new")[column]).otherwise(otherwise).alias(column)
    return otherwise.alias(column)


def _inserted(column: str, batch: DataFrame, defaults: Mapping[str, Column], data_type) -> Column:
    if column in batch.columns:
        return F.col(column)
    return defaults.get(column, F.lit(None).cast(data_type)).alias(column)


def _merged(target, batch, keys, defaults, dated=None):
    rest = [c for c in target.columns if c not in keys]
    before = target.select(*keys, F.struct(*rest).alias("_old"))
    out = before.join(_packed(batch, keys), keys, "full_outer")
    if dated:
        late = F.coalesce(F.col("_old")[dated] > F.col("_new")[dated], F.lit(False))
        out = out.withColumn("_new", F.when(~late, F.col("_new")))
    columns = []
    for name in target.columns:
        if name in keys:
            columns.append(F.col(name))
            continue
        kept = F.col("_old")[name]
        if name in defaults:
            kept = F.when(F.col("_old").isNotNull(), kept).otherwise(defaults[name])
        columns.append(_updated(name, batch, keys, kept))
    return out.select(*columns)


def merge_into(batch: DataFrame, table: str, keys: Sequence[str], defaults: Mapping[str, Column] | None = None) -> None:
    """The same upsert as one MERGE, for catalogs whose tables take row-level changes."""
    values = {c: F.col(f"b.{c}") for c in batch.columns}
    match = F.lit(True)
    for key in keys:
        match = match & (F.col(f"{table}.{key}") == F.col(f"b.{key}"))
    (
        batch.alias("b")
        .mergeInto(table, match)
        .whenMatched()
        .update({c: v for c, v in values.items() if c not in keys})
        .whenNotMatched()
        .insert({**(defaults or {}), **values})
        .merge()
    )
