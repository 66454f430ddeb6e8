"""Which part of a table changed, by order-free digests of key buckets.

Rows are dealt into buckets by key. A bucket's digest is its number of rows and the sum and the exclusive or
of a 64-bit hash of each row, so it does not depend on the order of rows or on files. Two tables with equal
digests of a bucket are taken to be equal in it. Digests are partial sums: a table is scanned, but a task
sends a row for each bucket and no data. Buckets that differ are divided further, so that what is compared
row by row at the end is little more than what changed.
"""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.snapshot import VERSION_COLUMNS, snapshot_changes

#: Buckets of the first level, and parts of each that differs. COARSE * FINE numbers are broadcast at most, 1 MB.
COARSE, FINE = 1 << 10, 1 << 7


def _place(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def bucket_digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    """(bucket, rows, digest): one row for each bucket that has rows."""
    row = F.xxhash64(*keys, *columns)
    total = F.sum(row.cast("decimal(20,0)"))
    return df.groupBy(_place(keys, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.struct(total.alias("sum"), F.bit_xor(row).alias("xor")).alias("digest")
    )


def different_buckets(
    before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int
) -> list[int]:
    """The buckets in which the two tables differ; at most `buckets` numbers."""
    a, b = (bucket_digests(df, keys, columns, buckets) for df in (before, after))
    both = a.join(b.withColumnsRenamed({"rows": "rows_b", "digest": "digest_b"}), "bucket", "full_outer")
    same = F.col("rows").eqNullSafe(F.col("rows_b")) & F.col("digest").eqNullSafe(F.col("digest_b"))
    return sorted(r["bucket"] for r in both.where(~same).select("bucket").collect())


def in_buckets(df: DataFrame, keys: Sequence[str], buckets: int, chosen: Sequence[int]) -> DataFrame:
    """The rows of the chosen buckets, found where they are read."""
    if len(chosen) == buckets:
        return df
    listed = df.sparkSession.createDataFrame([(b,) for b in chosen], "_bucket int")
    return df.join(F.broadcast(listed), _place(keys, buckets) == F.col("_bucket"), "left_semi")


def changed_parts(
    before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str], coarse: int = COARSE, fine: int = FINE
) -> tuple[DataFrame, DataFrame, int]:
    """Both tables reduced to the buckets in which they differ, and how many of coarse * fine these are."""
    keys, columns = list(keys), list(columns)
    chosen = different_buckets(before, after, keys, columns, coarse)
    before, after = (in_buckets(df, keys, coarse, chosen) for df in (before, after))
    if not chosen:
        return before, after, 0
    # coarse divides coarse * fine, so each fine bucket lies in one of the first level.
    chosen = different_buckets(before, after, keys, columns, coarse * fine)
    before, after = (in_buckets(df, keys, coarse * fine, chosen) for df in (before, after))
    return before, after, len(chosen)


def snapshot_changes_by_digest(
    open_rows: DataFrame | None,
    new: DataFrame,
    keys: Sequence[str],
    run_ts: dt.datetime,
    check_cols: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """`snapshot_changes`, comparing only the key buckets that differ.

    Worth it where most rows stay as they were and `new` is cheap to scan, as a stored table is: it is read
    up to three times, but what did not change is neither shuffled nor sorted. A key that is not in `new`
    makes its bucket differ and changes nothing. That keys are unique is checked in the buckets compared.
    """
    if open_rows is None:
        return snapshot_changes(None, new, keys, run_ts, check_cols, **options)
    columns = list(check_cols) if check_cols is not None else [c for c in new.columns if c not in keys]
    known = open_rows.select(*[c for c in open_rows.columns if c in new.columns or c in VERSION_COLUMNS])
    known, new, _ = changed_parts(known, new, keys, columns)
    return snapshot_changes(known, new, keys, run_ts, check_cols, **options)
