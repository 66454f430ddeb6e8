"""Which rows have a key of a set, told without moving the rows.

A key's 64-bit hash names a part and a place in each of three bitmaps of the part. The first bitmap has the
keys of the set, the second the other keys that the first has as well, the third those of the set that the
second has too. A row whose key the first lacks is outside, one that the first has and the second lacks is
inside, one that these have and the third lacks is outside. Keys in all three are few, and only their rows
meet the keys in a join. The bitmaps have PARTS * LEVELS * 4 KB at most, 12 MB, whatever the data; the more
keys they have, the more rows are joined, and all are told exactly.
"""

from __future__ import annotations

import functools
import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import stored

PARTS, PLACE_BITS, LEVELS = 1024, 15, 3


def _places(key: np.ndarray, level: int) -> np.ndarray:
    return ((key >> np.uint64(PLACE_BITS * level)) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)


def _part(key: Column, parts: int) -> Column:
    return F.pmod(F.shiftrightunsigned(key, PLACE_BITS * LEVELS), F.lit(parts)).cast("int")


def _has(bits: Column, key: Column, level: int) -> Column:
    """Whether the bitmap of the level has the key."""
    place = F.shiftrightunsigned(key, PLACE_BITS * level).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    byte = F.conv(F.hex(F.substring(F.get(bits, F.lit(level)), (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10)
    return F.coalesce(F.getbit(byte.cast("int"), place.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))


def bitmaps(keys: DataFrame, parts: int) -> DataFrame:
    """(_part, _bits, _open) of (_key, _in): the bitmaps of a part, and how many keys of the set are in all three."""

    def fill(group: pa.Table) -> pa.Table:
        key = group.column("_key").to_numpy().view(np.uint64)
        inside = group.column("_in").to_numpy()
        made, now, other = [], key[inside], key[~inside]
        for level in range(LEVELS):
            bits = np.zeros(1 << PLACE_BITS, bool)
            bits[_places(now, level)] = True
            made.append(np.packbits(bits, bitorder="little").tobytes())
            now, other = other[bits[_places(other, level)]], now
        columns = [group.column("_part")[:1], pa.array([made], pa.list_(pa.binary())), pa.array([len(other)], pa.int64())]
        return pa.table(columns, ["_part", "_bits", "_open"])

    placed = keys.withColumn("_part", _part(F.col("_key"), parts))
    return placed.groupBy("_part").applyInArrow(fill, "_part int, _bits array<binary>, _open bigint")


def with_membership(rows: DataFrame, keys: DataFrame, columns: list[str], name: str, parts: int = PARTS) -> DataFrame:
    """The rows with a column `name`: whether `keys`, which has the columns as well, has it true for their key.

    `keys` has a row for each key of the rows; of a key that it has more than once one true row counts. Nulls
    are values like others. It is read more than once.
    """
    hashed = F.xxhash64(*columns).alias("_key")
    told = stored(bitmaps(keys.select(hashed, F.col(name).alias("_in")), parts), "bitmaps")
    tested = rows.withColumn("_key", hashed)
    tested = tested.join(F.broadcast(told), _part(F.col("_key"), parts) == F.col("_part"), "left")
    first, second, third = (_has(F.col("_bits"), F.col("_key"), level) for level in range(LEVELS))
    if not told.agg(F.sum("_open")).first()[0]:
        return tested.select(*rows.columns, (first & ~second).alias(name))
    is_open = first & second & third
    clear = tested.where(~is_open).select(*rows.columns, (first & ~second).alias(name))
    few = keys.where(name).select(*(F.col(c).alias(f"_of_{c}") for c in columns), hashed).distinct()
    few = few.join(F.broadcast(told), _part(F.col("_key"), parts) == F.col("_part"))
    few = few.where(is_open).select(*(f"_of_{c}" for c in columns), F.lit(True).alias(name))
    rest = tested.where(is_open).select(*rows.columns)
    same = functools.reduce(operator.and_, (rest[c].eqNullSafe(few[f"_of_{c}"]) for c in columns))
    rest = rest.join(few, same, "left").select(*rows.columns, F.coalesce(name, F.lit(False)).alias(name))
    return clear.union(rest)
