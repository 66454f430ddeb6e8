"""Helpers shared by the operators: key contracts, lookups, and the version that was valid at a time."""

import functools
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

def single_per_key(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """Fail the job on a NULL key or a second row of the same key.

    The running number needs the rows hashed and sorted by key, which a join or merge
    on the same key needs anyway, so the check costs no exchange of its own. It keeps
    one counter per key: a key with very many rows is not collected, it fails on the
    second one.
    """
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    null_key = functools.reduce(operator.or_, [F.col(k).isNull() for k in keys])
    fail = lambda text: F.raise_error(F.lit(text)).cast("boolean")
    verdict = (
        F.when(null_key, fail(f"{what}: NULL in key {tuple(keys)}"))
        .when(F.col("_number") > 1, fail(f"{what}: more than one row for a value of key {tuple(keys)}"))
        .otherwise(F.lit(True))
    )
    return df.withColumn("_number", number).where(verdict).drop("_number")


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """Keep the row with the largest `order_by` of each key.

    An aggregate, not a window: rows of a hot key shrink to one per map task before the
    shuffle. Equal `order_by` is settled by the other columns, so the result is stable.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[order_by, *[c for c in rest if c != order_by]])
    return df.groupBy(*keys).agg(F.max(ranked).alias("_row")).select(
        *[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns]
    )


def one_row_per_key(
    df: DataFrame, keys: Sequence[str], what: str, on_duplicates: str = "error", order_by: str = "updated_at"
) -> DataFrame:
    if on_duplicates == "error":
        return single_per_key(df, keys, what)
    if on_duplicates == "latest":
        return latest_per_key(df, keys, order_by)
    raise ValueError(f"on_duplicates is 'error' or 'latest', not {on_duplicates!r}")


def lookup(df: DataFrame, dim: DataFrame, natural: str, surrogate: str, on: str, name: str) -> DataFrame:
    """Add `name`, the surrogate of each dimension row whose natural key equals `on`.

    An inner join: rows without a match drop out, rows with several matches repeat. No hint is
    given, so the join is by hash and sort unless the bytes that were shuffled show at run time
    that the dimension can be broadcast.
    """
    side = dim.select(F.col(natural).alias("_natural"), F.col(surrogate).alias(name))
    return df.join(side, df[on] == side["_natural"], "inner").drop("_natural")


def hot_keys(df: DataFrame, key: str, parts: int) -> DataFrame:
    """(key, shares) of the keys that hold more than one `parts`-th of the rows.

    There are fewer than `parts` of them, and their shares, one for each such part begun, are at most
    twice as many. Counted per task before the shuffle.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    share = F.col("_rows") * parts / counts.agg(F.sum("_rows")).scalar()
    return counts.where(share > 1).select(key, F.ceil(share).cast("int").alias("shares"))


def as_of_lookup(
    df: DataFrame,
    history: DataFrame,
    natural: str,
    on: str,
    at: str,
    columns: Mapping[str, str],
    valid_from: str,
    valid_to: str,
    how: str = "inner",
    backdate: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """Add `columns` (name in the history: new name) of the version of key `on` that was valid at time `at`.

    A version is valid from `valid_from`, that moment included, until before `valid_to`, or for good where
    that is NULL. `backdate` lets the first version of a key hold from the beginning of time. Versions of a
    key must not overlap; of two that begin at once the one that lasts longer counts. Rows whose key is not
    in the history, or NULL, or whose time is NULL or in no version, drop out, or with `how="left"` get
    NULLs. The three times are of one type.

    Rows and versions are put in one order of time for each key and the last version seen is carried on, so
    however many versions a key has, they are neither compared with nor multiplied by the rows. A key with
    more than one `parts`-th of the rows (default: of the shuffle partitions) is dealt over several
    tasks, each of which gets its versions.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how is 'inner' or 'left', not {how!r}")
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Fewer than `parts` rows, whatever the data.
    hot = F.broadcast(hot_keys(df.select(F.col(on).alias("_key")), "_key", parts))
    shares = F.coalesce(F.col("shares"), F.lit(1))
    # A row's share depends on the row alone, so a task that runs again deals it alike.
    rows = df.select(
        F.col(on).alias("_key"), F.col(at).alias("_at"), F.struct(*df.columns).alias("_row"), F.xxhash64(*df.columns).alias("_hash")
    )
    rows = rows.join(hot, "_key", "left").select(
        "_key", F.pmod("_hash", shares).cast("int").alias("_share"), "_at", F.lit(1).alias("_kind"), "_row"
    )
    found = F.struct(F.col(valid_to).alias("_to"), *[F.col(c).alias(new) for c, new in columns.items()])
    versions = history.select(F.col(natural).alias("_key"), F.col(valid_from).alias("_at"), found.alias("_version"))
    if backdate:
        first = F.min("_at").over(Window.partitionBy("_key"))
        versions = versions.withColumn("_at", F.when(F.col("_at") > first, F.col("_at")))
    versions = versions.join(hot, "_key", "left").select(
        "_key", F.explode(F.sequence(F.lit(0), shares - 1)).alias("_share"), "_at", F.lit(0).alias("_kind"), "_version"
    )
    order = Window.partitionBy("_key", "_share").orderBy("_at", "_kind", F.col("_version._to").asc_nulls_last())
    seen = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = rows.unionByName(versions, allowMissingColumns=True)
    carried = both.withColumn("_last", F.last("_version", ignorenulls=True).over(seen)).where("_kind = 1")
    last = F.col("_last")
    known = last.isNotNull() & F.col("_key").isNotNull() & F.col("_at").isNotNull()
    valid = known & F.coalesce(F.col("_at") < last["_to"], F.lit(True))
    if how == "inner":
        carried = carried.where(valid)
    return carried.select(
        *[F.col("_row")[c].alias(c) for c in df.columns],
        *[F.when(valid, last[new]).alias(new) for new in columns.values()],
    )
