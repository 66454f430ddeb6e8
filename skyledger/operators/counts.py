"""Counts per key and the joins that use them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_per_key(df: DataFrame, key: str, counted: str, name: str, where: Column | None = None) -> DataFrame:
    """COUNT(counted) per key; NULLs are not counted. Partial counts are made before the shuffle."""
    if where is not None:
        df = df.where(where)
    return df.groupBy(key).agg(F.count(counted).alias(name))


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))
