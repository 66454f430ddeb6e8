"""Rules a database would enforce on write, as frames of what breaks them."""

import functools
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.values import key_part
from skyledger.schemas import Table


class RuleBroken(Exception):
    """Raised by `enforce` when a check finds anything."""


def not_null_rules(columns: Sequence[str]) -> dict[str, Column]:
    return {f"not_null_{c}": F.col(c).isNotNull() for c in columns}


def row_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The rows that break a rule, once per rule, with its name in `rule`.

    All rules are tested in one scan. As for an SQL CHECK, a rule that is NULL holds.
    """
    broken = F.array(*[F.when(~holds, F.lit(name)) for name, holds in rules.items()])
    any_broken = functools.reduce(operator.or_, [~holds for holds in rules.values()])
    return df.where(any_broken).select(F.explode(broken).alias("rule"), "*").where(F.col("rule").isNotNull())


def table_rules(table: Table) -> dict[str, Column]:
    return {**not_null_rules(table.required), **{name: F.expr(text) for name, text in table.checks}}


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their `rows`.

    Counts are partial before the shuffle, so a hot key sends one row per task. NULLs
    never clash with each other, as in an SQL UNIQUE.
    """
    filled = df.dropna(subset=list(keys)) if keys else df
    return filled.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


#: Bits of a key bitmap. Bitmaps are at most this many bits in all, 2 MB, whatever the data.
KEY_BITS = 1 << 24


def key_bitmaps(df: DataFrame, columns: Sequence[str], bits: int = KEY_BITS) -> DataFrame:
    """(_part, _bits): bitmaps in which the hash of each key of `df` has its bit set."""
    place = _key_place(columns, bits)
    return df.groupBy(F.bitmap_bucket_number(place).alias("_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits")
    )


def _key_place(columns: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(bits)) + 1


def with_key_in(
    df: DataFrame, columns: Sequence[str], bitmaps: DataFrame, bits: int = KEY_BITS, invert: bool = False
) -> DataFrame:
    """The rows whose key may be among those of the bitmaps: all that are, and few others.

    With `invert` the rows whose key is surely not among them, which are all others. The bitmaps, bounded
    by `bits`, are sent to every task, so rows are left out where they are read, before any exchange.
    """
    place = _key_place(columns, bits)
    position = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = df.join(F.broadcast(bitmaps), F.bitmap_bucket_number(place) == F.col("_part"), "left" if invert else "inner")
    is_set = F.getbit(byte, (position % 8).cast("int")) == 1
    return found.where(~F.coalesce(is_set, F.lit(False)) if invert else is_set).select(*df.columns)


def orphan_keys(
    child: DataFrame,
    parent: DataFrame,
    child_cols: Sequence[str],
    parent_cols: Sequence[str] | None = None,
    few: bool = True,
) -> DataFrame:
    """References of `child` that no row of `parent` has, with the number of child rows.

    The child is reduced to one row per reference before the anti-join, so neither a hot
    reference nor wide rows are shuffled. With `few` a bitmap of these references leaves most other
    rows of the parent out where they are read; what is left is compared exactly. The references of
    a whole large table would fill the bitmap, which then costs more than it leaves out. A reference
    with a NULL in it is not checked.
    """
    parent_cols = list(parent_cols or child_cols)
    types = dict(child.dtypes)
    refs = child.dropna(subset=list(child_cols)).groupBy(*child_cols).agg(F.count(F.lit(1)).alias("rows"))
    known = parent.select(*[F.col(p).cast(types[c]).alias(c) for p, c in zip(parent_cols, child_cols)])
    if few:
        known = with_key_in(known, child_cols, key_bitmaps(refs, child_cols))
    return refs.join(known, list(child_cols), "left_anti")


def _listed(found: DataFrame, rule: Column | str, columns: Sequence[str], rows: Column) -> DataFrame:
    """Violations in one shape: rule, key text, rows."""
    rule = F.lit(rule) if isinstance(rule, str) else rule
    key = F.concat_ws("|", *[F.coalesce(key_part(F.col(c)), F.lit("NULL")) for c in columns])
    return found.select(rule.alias("rule"), key.alias("key"), rows.cast("bigint").alias("rows"))


def _row_and_reference_violations(
    table: Table, df: DataFrame, parents: Mapping[str, DataFrame], few: bool
) -> list[DataFrame]:
    parts = [_listed(row_violations(df, table_rules(table)), F.col("rule"), table.key, F.lit(1))]
    for ref in table.references:
        found = orphan_keys(df, parents[ref.parent], ref.columns, ref.parent_columns, few)
        parts.append(_listed(found, f"{'_'.join(ref.columns)}_in_{ref.parent}", ref.columns, F.col("rows")))
    return parts


def _unique_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _listed(duplicate_keys(df, columns), f"unique_{'_'.join(columns)}", columns, F.col("rows"))


def _collected(table: Table, parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts).select(F.lit(table.name).alias("table"), "*")


def table_violations(table: Table, frames: Mapping[str, DataFrame]) -> DataFrame:
    """Every broken rule of one staging table: table, rule, key text, rows."""
    df = frames[table.name]
    parts = _row_and_reference_violations(table, df, frames, few=False)
    return _collected(table, parts + [_unique_violations(df, columns) for columns in (table.key, *table.unique)])


def batch_violations(
    table: Table,
    after: DataFrame,
    batch_keys: DataFrame | None,
    parents: Mapping[str, DataFrame],
    clashes: Mapping[tuple[str, ...], DataFrame],
) -> DataFrame:
    """Rules that a batch broke in the table `after` it, of which the buckets it touched suffice.

    Without `batch_keys` all rows of the table are the batch's. Only rows with a key of the batch are tested: rows loaded earlier passed then, and parents
    are never deleted. `clashes` holds, for each further unique key, its values that several rows
    have now and the batch brought (see `keyindex`). The key itself is not tested, an upsert
    cannot repeat it.
    """
    keys = list(table.key)
    touched = after.dropna(subset=keys) if batch_keys is None else after.join(batch_keys.select(*keys), keys, "left_semi")
    parts = _row_and_reference_violations(table, touched, parents, few=batch_keys is not None)
    parts += [_listed(clashes[c], f"unique_{'_'.join(c)}", c, F.col("rows")) for c in table.unique]
    return _collected(table, parts)


def enforce(violations: DataFrame) -> None:
    """Fail when there is any violation, naming a few of them."""
    found = violations.limit(5).collect()
    if found:
        raise RuleBroken("; ".join(str(row.asDict()) for row in found))
