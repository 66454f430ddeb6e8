import random

import pytest
from failures import JOB_FAILURE
from pyspark.sql import functions as F

from skyledger.operators.upsert import first_rows, merge_into, upsert

SCHEMA = "k1 int, k2 string, id string, v int, w string"


def expected(target, batch, columns, keys):
    """Row by row, as a database would."""
    table = {tuple(r[k] for k in keys): dict(r) for r in target}
    for row in batch:
        key = tuple(row[k] for k in keys)
        fresh = {"id": "new"} if key not in table else {}
        table.setdefault(key, dict.fromkeys(columns)).update({**fresh, **row})
    return sorted((tuple(r[c] for c in columns) for r in table.values()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_matches_row_by_row(spark, seed):
    rng = random.Random(seed)
    columns, keys = ["k1", "k2", "id", "v", "w"], ["k1", "k2"]
    pairs = [(i, s) for i in range(20) for s in "ab"]
    target = [dict(k1=a, k2=b, id=f"{a}{b}", v=rng.choice([None, 1, 2]), w="t") for a, b in rng.sample(pairs, 25)]
    batch = [dict(k1=a, k2=b, v=rng.choice([None, 1, 2])) for a, b in rng.sample(pairs, 20)]
    t = spark.createDataFrame([tuple(r[c] for c in columns) for r in target], SCHEMA)
    b = spark.createDataFrame([(r["k1"], r["k2"], r["v"]) for r in batch], "k1 int, k2 string, v int")
    got = upsert(t, b, keys, {"id": F.lit("new")})
    assert got.columns == columns
    assert sorted(map(tuple, got.collect()), key=repr) == expected(target, batch, columns, keys)
    again = upsert(got, b, keys, {"id": F.lit("other")})
    assert sorted(map(tuple, again.collect()), key=repr) == expected(target, batch, columns, keys)


def test_one_plan_whatever_the_size_on_disk(spark, tmp_path):
    """A batch of few bytes and many rows is merged like any other; nothing is broadcast by hint."""
    spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("w")).write.parquet(f"{tmp_path}/t")
    spark.range(200_000).select(F.col("id").cast("int").alias("k"), F.lit("y").alias("w")).write.parquet(f"{tmp_path}/b")
    target, batch = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/b")
    for one, rows in ((batch, 200_000), (batch.where("k < 5"), 1000)):
        df = upsert(target, one, ["k"])
        assert df.where("w = 'y'").count() == one.count() and df.count() == rows
        assert "Hint" not in df._jdf.queryExecution().analyzed().toString()


def test_duplicate_or_null_keys_fail(spark):
    target = spark.createDataFrame([(1, "a")], "k int, w string")
    for rows in ([(1, "x"), (1, "y")], [(None, "x")]):
        batch = spark.createDataFrame(rows, "k int, w string")
        with pytest.raises(JOB_FAILURE, match="key"):
            upsert(target, batch, ["k"]).collect()


def test_latest_of_duplicates(spark):
    target = spark.createDataFrame([(1, "a", 0)], "k int, w string, updated_at int")
    batch = spark.createDataFrame([(1, "x", 5), (1, "y", 7), (2, None, 1)], "k int, w string, updated_at int")
    got = upsert(target, batch, ["k"], on_duplicates="latest").collect()
    assert sorted(map(tuple, got)) == [(1, "y", 7), (2, None, 1)]


def test_first_batch_equals_upsert_into_an_empty_table(spark):
    batch = spark.createDataFrame([(1, "a", 5), (2, "b", None)], "k1 int, k2 string, v int")
    empty = spark.createDataFrame([], SCHEMA)
    defaults = {"id": F.concat("k1", "k2")}
    first = first_rows(batch, empty.schema, ["k1", "k2"], defaults)
    merged = upsert(empty, batch, ["k1", "k2"], defaults)
    assert first.columns == merged.columns
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, merged.collect())) == [
        (1, "a", "1a", 5, None), (2, "b", "2b", None, None),
    ]


def test_unknown_columns_are_refused(spark):
    target = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError, match="unknown"):
        upsert(target, spark.createDataFrame([(1, 2)], "k int, z int"), ["k"])
    with pytest.raises(ValueError, match="lacks"):
        upsert(target, spark.createDataFrame([], "z int").drop("z"), ["k"])


def test_merge_needs_a_catalog_with_row_level_changes(spark, tmp_path):
    spark.sql(f"CREATE TABLE plain_target (k INT, w STRING) USING parquet LOCATION '{tmp_path}/plain'")
    try:
        with pytest.raises(JOB_FAILURE, match="(?i)merge"):
            merge_into(spark.createDataFrame([(1, "x")], "k int, w string"), "plain_target", ["k"])
    finally:
        spark.sql("DROP TABLE plain_target")
