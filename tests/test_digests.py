"""Digests of key buckets: what differs is found, and nothing else is compared."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from skyledger.operators.digests import bucket_digests, changed_parts, different_buckets, snapshot_changes_by_digest
from skyledger.operators.snapshot import first_versions, snapshot_changes

AT = [dt.datetime(2024, 1, d) for d in (1, 2)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('t')}/rows"
    spark.range(20_000).select(
        "id", (F.col("id") % 7).cast("string").alias("w"), F.when(F.col("id") % 5 > 0, F.col("id") * 1.5).alias("v")
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_order_and_partitions_do_not_matter(table):
    again = table.orderBy(F.desc("w"), "v").repartition(7)
    assert different_buckets(table, again, ["id"], ["w", "v"], 64) == []
    assert rows(bucket_digests(table, ["id"], ["w", "v"], 64)) == rows(bucket_digests(again, ["id"], ["w", "v"], 64))


@pytest.mark.parametrize("change", ["value", "null", "gone", "new"])
def test_one_changed_row_is_one_bucket(table, change):
    hit = F.col("id") == 4711
    after = {
        "value": lambda: table.withColumn("w", F.when(hit, "x").otherwise(F.col("w"))),
        "null": lambda: table.withColumn("v", F.when(~hit, F.col("v"))),
        "gone": lambda: table.where(~hit),
        "new": lambda: table.union(table.where(hit).withColumn("id", F.lit(-1).cast("bigint"))),
    }[change]()
    a, b, n = changed_parts(table, after, ["id"], ["w", "v"])
    assert n == 1 and max(a.count(), b.count()) < 5
    assert changed_parts(table, table, ["id"], ["w", "v"])[2] == 0


def test_rows_that_exchange_values_differ(table):
    """Sums over a bucket do not cancel out, as each row's hash has its key in it."""
    pair = table.where("id IN (1, 8)").orderBy("id").collect()
    swapped = F.when(F.col("id") == 1, F.lit(pair[1].v)).when(F.col("id") == 8, F.lit(pair[0].v)).otherwise(F.col("v"))
    assert different_buckets(table, table.withColumn("v", swapped), ["id"], ["w", "v"], 1) == [0]


@pytest.mark.parametrize("share", [0.0, 0.01, 0.6])
def test_snapshot_is_the_same(spark, table, share):
    rng = random.Random(3)
    known = first_versions(table, ["id"], AT[0])
    hits = [i for i in range(20_100) if rng.random() < share]
    chosen = spark.createDataFrame([(i,) for i in hits], "id bigint")
    fresh = chosen.select("id", F.lit("changed").alias("w"), F.lit(None).cast("double").alias("v"))
    new = table.where("id % 9 > 0").join(chosen, "id", "left_anti").union(fresh)
    want = rows(snapshot_changes(known, new, ["id"], AT[1]))
    assert rows(snapshot_changes_by_digest(known, new, ["id"], AT[1])) == want
    assert (len(want) > 0) == (share > 0)
    assert rows(snapshot_changes_by_digest(None, new, ["id"], AT[0])) == rows(snapshot_changes(None, new, ["id"], AT[0]))


def test_empty_sides(spark, table):
    none = table.where("false")
    assert changed_parts(none, none, ["id"], ["w", "v"])[2] == 0
    a, b, n = changed_parts(none, table, ["id"], ["w", "v"])
    assert a.count() == 0 and b.count() == 20_000 and n > 1000
