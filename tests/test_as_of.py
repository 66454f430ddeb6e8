"""The version that was valid at a time, against row-by-row search."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from skyledger.operators.joins import as_of_lookup, hot_keys

DAY = [dt.datetime(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]
ROW, VERSION = "n int, k string, at timestamp_ntz", "nk string, name string, f timestamp_ntz, t timestamp_ntz"


def plain(rows, versions, backdate=False):
    out = []
    for n, k, at in rows:
        mine = [v for v in versions if v[0] == k and k is not None]
        first = min((v[2] for v in mine), default=None)
        valid = [
            v for v in mine
            if at is not None and (v[2] <= at or (backdate and v[2] == first)) and (v[3] is None or at < v[3])
        ]
        out.append((n, k, at, max(valid, key=lambda v: v[2])[1] if valid else None))
    return sorted(out, key=repr)


def found(spark, rows, versions, **options):
    df = spark.createDataFrame(rows, ROW).repartition(3)
    history = spark.createDataFrame(versions, VERSION)
    got = as_of_lookup(df, history, "nk", "k", "at", {"name": "version"}, "f", "t", **options)
    assert got.columns == ["n", "k", "at", "version"]
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(9)
    versions = []
    for k in "abcdefgh":
        cuts = sorted(rng.sample(DAY[5:35], rng.randrange(1, 8)))
        for i, cut in enumerate(cuts):
            end = cuts[i + 1] if i + 1 < len(cuts) else rng.choice([None, DAY[36]])
            versions.append((k, f"{k}{i}", cut, end))
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", "d", "e", "z", None]), rng.choice([*DAY, None])) for i in range(600)]
    edges = [(1000 + i, v[0], v[2 + i % 2]) for i, v in enumerate(versions)]
    return rows + edges + rows[:9], versions


@pytest.mark.parametrize("backdate", [False, True])
@pytest.mark.parametrize("parts", [1, 8, 50])
def test_as_by_search(spark, data, parts, backdate):
    rows, versions = data
    want = plain(rows, versions, backdate)
    assert found(spark, rows, versions, how="left", parts=parts, backdate=backdate) == want
    assert found(spark, rows, versions, parts=parts, backdate=backdate) == [r for r in want if r[3] is not None]


def test_no_rows_and_no_versions(spark, data):
    rows, versions = data
    assert found(spark, [], versions, how="left") == []
    assert found(spark, rows, []) == []
    assert found(spark, rows, [], how="left") == plain(rows, [])
    with pytest.raises(ValueError):
        found(spark, rows, versions, how="outer")


def test_hot_keys_are_few_and_dealt(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert [tuple(r) for r in hot_keys(df, "k", 16).collect()] == [(-1, 6)]
    every = hot_keys(spark.range(1000).select((F.col("id") % 7).alias("k")), "k", 16).collect()
    assert len(every) == 7 and sum(r.shares for r in every) < 32


def test_versions_do_not_multiply_rows(spark, tmp_path):
    """Neither a range join nor a nested loop; the hot key's rows go to several tasks."""
    spark.range(3000).selectExpr("id AS n", "CAST(id % 3 AS STRING) AS k", "TIMESTAMP_NTZ '2024-01-05' AS at").write.parquet(f"{tmp_path}/r")
    rows = spark.read.parquet(f"{tmp_path}/r")
    history = spark.createDataFrame([("0", "x", DAY[0], None)], VERSION)
    got = as_of_lookup(rows, history, "nk", "k", "at", {"name": "version"}, "f", "t", parts=8)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    assert got.where("version = 'x'").count() == got.count() == 1000
