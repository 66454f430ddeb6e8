"""Indexes of further unique keys: which row has a value.

An index has a row (value columns, key columns of the table) for each row of the table whose value has no
NULL in it. A batch changes the entries of the rows it touches and nothing else, so whether it brings a
value that another row has is seen in the index alone, in the buckets of the values concerned.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COME = "come"


def entries(rows: DataFrame, columns: Sequence[str], key: Sequence[str]) -> DataFrame:
    """The index of `rows`."""
    own = list(dict.fromkeys([*columns, *key]))
    return rows.select(*own).dropna(subset=list(columns))


def changed_entries(
    before: DataFrame | None, after: DataFrame, batch_keys: DataFrame | None, columns: Sequence[str], key: Sequence[str]
) -> DataFrame:
    """Entries that a batch takes away (`come` false) and brings (true); a value that stays is in neither.

    `before` and `after` are the rows of the buckets that the batch touches; without `batch_keys` all rows of
    `after` are the batch's.
    """
    columns, key = list(columns), list(key)
    touched = after.dropna(subset=key) if batch_keys is None else after.join(batch_keys.select(*key), key, "left_semi")
    new = touched.select(*key, F.struct(*columns).alias("_new"))
    if before is None:
        pairs = new.withColumn("_old", F.lit(None).cast(new.schema["_new"].dataType))
    else:
        pairs = new.join(before.select(*key, F.struct(*columns).alias("_old")), key, "left")
    pairs = pairs.where(~F.col("_new").eqNullSafe(F.col("_old")))
    both = F.explode(
        F.array(
            F.struct(F.lit(True).alias(COME), F.col("_new").alias("_value")),
            F.struct(F.lit(False).alias(COME), F.col("_old").alias("_value")),
        )
    )
    changed = pairs.select(*key, both.alias("_e")).where("_e._value IS NOT NULL")
    own = [F.col("_e._value")[c].alias(c) for c in columns] + [F.col(k) for k in key if k not in columns]
    return changed.select(F.col("_e")[COME].alias(COME), *own).dropna(subset=columns)


def after_changes(index: DataFrame | None, changes: DataFrame) -> DataFrame:
    """The index, or some buckets of it, after the changes of a batch."""
    come = changes.where(F.col(COME)).drop(COME)
    if index is None:
        return come
    gone = changes.where(~F.col(COME)).drop(COME)
    return index.join(gone, gone.columns, "left_anti").select(come.columns).unionByName(come)


def clashes(index: DataFrame, changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The values that a batch brought and more than one row has, with the number of `rows`."""
    columns = list(columns)
    come = changes.where(F.col(COME)).select(*columns).distinct()
    found = index.join(come, columns, "left_semi")
    return found.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
