import datetime as dt
import random

import pytest
from failures import JOB_FAILURE
from pyspark.sql import functions as F

from skyledger.operators.snapshot import VERSION_COLUMNS, snapshot_changes, snapshot_check, snapshot_step, visible_versions
from skyledger.sources.store import Store

DAY = [dt.datetime(2024, 1, d, 6) for d in range(1, 10)]
SCHEMA = "a int, b string, v int, w string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def brute(history, new, run_ts, checks=("v", "w")):
    """One run over a list of dicts."""
    out = [dict(h) for h in history]
    current = {(h["a"], h["b"]): h for h in out if h["end"] is None}
    for n in new:
        old = current.get((n["a"], n["b"]))
        if old is not None and all(old[c] == n[c] for c in checks):
            continue
        if old is not None:
            old["end"] = run_ts
        out.append({**n, "start": run_ts, "end": None})
    return out


@pytest.mark.parametrize("checks", [("v", "w"), ("v",)])
def test_many_runs_match_brute_force(spark, tmp_path, checks):
    rng = random.Random(7)
    store, history, expected = Store(spark, str(tmp_path)), None, []
    for run, at in enumerate(DAY[:3]):
        keys = rng.sample([(a, b) for a in range(6) for b in "xy"], 9)
        new = [dict(a=a, b=b, v=rng.choice([None, 1]), w=rng.choice([None, "p"])) for a, b in keys]
        df = spark.createDataFrame([(r["a"], r["b"], r["v"], r["w"]) for r in new], SCHEMA)
        expected = brute(expected, new, at, checks)
        current = store.read_open("final.h") if run else None
        store.write_history("final.h", snapshot_step(current, df, ["a", "b"], at, checks))
        history = snapshot_check(history, df, ["a", "b"], at, checks)
        want = sorted(((r["a"], r["b"], r["v"], r["w"], r["start"], r["end"]) for r in expected), key=repr)
        columns = ["a", "b", "v", "w", "dbt_valid_from", "dbt_valid_to"]
        assert rows(history.select(columns)) == want
        assert rows(store.read_history("final.h").select(columns)) == want
        assert rows(store.read_history("final.h")) == rows(history)
    assert store.read_history("final.h").where("dbt_valid_to IS NULL").groupBy("a", "b").count().where("count > 1").isEmpty()


def test_value_to_null_and_back_gives_three_versions(spark):
    history = None
    for at, email in zip(DAY, (None, "e", None)):
        df = spark.createDataFrame([(1, email)], "k int, email string")
        history = snapshot_check(history, df, ["k"], at)
    got = history.orderBy("dbt_valid_from").select("email", "dbt_valid_from", "dbt_valid_to").collect()
    assert [tuple(r) for r in got] == [(None, DAY[0], DAY[1]), ("e", DAY[1], DAY[2]), (None, DAY[2], None)]


def test_same_load_twice_changes_nothing(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "k int, w string")
    once = snapshot_check(None, df, ["k"], DAY[0])
    assert rows(snapshot_check(once, df, ["k"], DAY[1])) == rows(once)


def test_version_columns(spark):
    df = spark.createDataFrame([(1, "x")], "k int, w string")
    got = snapshot_check(None, df, ["k"], dt.datetime(2024, 1, 1, 6, 0, 0, 250000))
    assert got.columns == ["k", "w", *VERSION_COLUMNS]
    row = got.first()
    want = spark.sql("SELECT md5('1|2024-01-01 06:00:00.25')").first()[0]
    assert row["dbt_scd_id"] == want and row["dbt_updated_at"] == row["dbt_valid_from"] and row["dbt_valid_to"] is None


def test_columns_outside_the_check_list_change_with_a_new_version_only(spark):
    load = lambda v, w: spark.createDataFrame([(1, v, w)], "k int, v int, w string")
    history = snapshot_check(None, load(1, "a"), ["k"], DAY[0], ["v"])
    history = snapshot_check(history, load(1, "b"), ["k"], DAY[1], ["v"])
    assert [(r.v, r.w) for r in history.collect()] == [(1, "a")]
    history = snapshot_check(history, load(2, "c"), ["k"], DAY[2], ["v"])
    assert sorted((r.v, r.w) for r in history.collect()) == [(1, "a"), (2, "c")]


def test_duplicate_keys_fail_in_the_plan(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y")], "k int, w string")
    with pytest.raises(JOB_FAILURE, match="more than one row"):
        snapshot_check(None, df, ["k"], DAY[0]).collect()


def test_changed_types_are_refused(spark):
    history = snapshot_check(None, spark.createDataFrame([(1, "x")], "k int, w string"), ["k"], DAY[0])
    with pytest.raises(ValueError, match="do not match"):
        snapshot_check(history, spark.createDataFrame([(1, 2)], "k int, w int"), ["k"], DAY[1])


def test_one_exchange_per_side(spark, tmp_path):
    """Key check, join and both versions of a row share one hash of each side."""
    spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("w")).write.parquet(f"{tmp_path}/n")
    new = spark.read.parquet(f"{tmp_path}/n")
    store = Store(spark, f"{tmp_path}/s")
    store.write_history("final.h", snapshot_step(None, new, ["k"], DAY[0]))
    step = snapshot_step(store.read_open("final.h"), new, ["k"], DAY[1])
    plan = step._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("SortMergeJoin") == 1


def test_closed_versions_are_not_read_by_the_next_run(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for at, w in zip(DAY, "abc"):
        current = store.read_open("final.h") if store.exists("final.h") else None
        df = spark.createDataFrame([(1, w)], "k int, w string")
        store.write_history("final.h", snapshot_step(current, df, ["k"], at))
    assert store.read_history("final.h").count() == 3 and store.read_open("final.h").count() == 1
    assert all("store_segment=open" in f and "store_version=3" in f for f in store.read_open("final.h").select(F.input_file_name()).first())


def test_unfinished_version_is_ignored(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write("stg.t", spark.range(3))
    (tmp_path / "stg/t/store_version=2").mkdir()  # a job that died before its commit
    assert store.versions("stg.t") == [1] and store.read("stg.t").count() == 3
    store.write("stg.t", store.read("stg.t").where("id > 0"))
    assert store.versions("stg.t") == [1, 3] and store.read("stg.t").count() == 2


def test_superseded_rows_can_be_dropped(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for at, w in zip(DAY, "abcd"):
        current = store.read_open("final.h") if store.exists("final.h") else None
        df = spark.createDataFrame([(1, w), (2, "same")], "k int, w string")
        store.write_history("final.h", snapshot_step(current, df, ["k"], at))
        store.write("stg.t", df)
    (tmp_path / "stg/t/store_version=5").mkdir()
    before = rows(store.read_history("final.h"))
    store.drop_superseded("final.h")
    store.drop_superseded("stg.t")
    assert rows(store.read_history("final.h")) == before and store.versions("stg.t") == [3, 4]
    assert len(list((tmp_path / "final/h").glob("*/store_segment=open"))) == 2
    assert (tmp_path / "stg/t/store_version=5").exists()  # may be a write in progress


def test_visible_versions(spark):
    history = snapshot_check(None, spark.createDataFrame([(1, "x")], "k int, w string"), ["k"], DAY[0])
    history = snapshot_check(history, spark.createDataFrame([(1, "y")], "k int, w string"), ["k"], DAY[1])
    assert visible_versions(history, "all").count() == 2
    assert [r.w for r in visible_versions(history, "current").collect()] == ["y"]
    with pytest.raises(ValueError):
        visible_versions(history, "latest")


def keep(store, spark, run, values):
    """One run that stores its changes; values by key, a key without one is not part of the run."""
    df = spark.createDataFrame(list(values.items()), "k int, w string")
    known = store.read_open("final.h") if store.exists("final.h") else None
    store.append_history("final.h", snapshot_changes(known, df, ["k"], DAY[run]))
    return df


def segments(root, version):
    return {p.name.split("=")[1] for p in root.glob(f"final/h/store_version={version}/store_segment=*")}


def test_an_unchanged_run_writes_no_rows(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for run in range(3):
        keep(store, spark, run, {1: "x", 2: None})
    assert [segments(tmp_path, v) for v in (1, 2, 3)] == [{"open"}, set(), set()]
    keep(store, spark, 3, {1: "y", 3: "z"})
    assert segments(tmp_path, 4) == {"opened", "closed"}
    assert {(r.k, r.w) for r in store.read_open("final.h").collect()} == {(1, "y"), (2, None), (3, "z")}
    written = list((tmp_path / "final/h/store_version=4").rglob("*.parquet"))
    assert sum(spark.read.parquet(str(p)).count() for p in written) == 3


@pytest.mark.parametrize("compact_after", [1, 2, 3, 99])
def test_changes_of_many_runs_are_the_whole_history(spark, tmp_path, compact_after):
    rng = random.Random(2)
    store, history = Store(spark, str(tmp_path), compact_after=compact_after), None
    for run in range(6):
        df = keep(store, spark, run, {k: rng.choice([None, "a", "b"]) for k in rng.sample(range(8), 5)})
        history = snapshot_check(history, df, ["k"], DAY[run])
        assert rows(store.read_history("final.h")) == rows(history)
        assert rows(store.read_open("final.h")) == rows(history.where("dbt_valid_to IS NULL"))
        if run == 4:
            store.drop_superseded("final.h", keep=1)
            assert rows(store.read_history("final.h")) == rows(history)
    bases = len(list(tmp_path.glob("final/h/*/store_segment=open")))
    assert bases == 1 if compact_after == 99 else bases >= 1


def test_a_history_without_rows(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    keep(store, spark, 0, {})
    assert store.read_open("final.h").columns == ["k", "w", *VERSION_COLUMNS] and store.read_history("final.h").isEmpty()
    keep(store, spark, 1, {5: "x"})
    keep(store, spark, 2, {5: "y"})
    assert [(r.w, r.dbt_valid_from, r.dbt_valid_to) for r in store.read_history("final.h").orderBy("dbt_valid_from").collect()] == [
        ("x", DAY[1], DAY[2]), ("y", DAY[2], None),
    ]


def test_changes_in_parts_are_one_version(spark, tmp_path):
    whole, parted = Store(spark, f"{tmp_path}/a"), Store(spark, f"{tmp_path}/b")
    for run, values in enumerate(({1: "x", 2: "x", 3: None}, {1: "y", 2: "x", 4: "z"})):
        df = keep(whole, spark, run, values)
        known = parted.read_open("final.h") if run else None
        part = lambda d, i: d if d is None else d.where(F.col("k") % 2 == i)
        parted.append_history("final.h", *[snapshot_changes(part(known, i), part(df, i), ["k"], DAY[run]) for i in (0, 1)])
    assert parted.versions("final.h") == [1, 2] and rows(parted.read_history("final.h")) == rows(whole.read_history("final.h"))


def test_changes_are_written_where_they_were_compared(spark, tmp_path, monkeypatch):
    """A shuffle of all changes before they are written took several times the disk of their files."""
    store = Store(spark, str(tmp_path))
    hints = []
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda df, *name: hints.append(name) or df)
    keep(store, spark, 0, {k: "x" for k in range(50)})
    keep(store, spark, 1, {k: "y" for k in range(50)})
    assert not hints and store.read_history("final.h").count() == 100


def test_small_files_of_changes_become_few(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    keep(store, spark, 0, {k: "x" for k in range(50)})
    new = spark.createDataFrame([(k, "y") for k in range(50)], "k int, w string")
    changes = snapshot_changes(store.read_open("final.h"), new, ["k"], DAY[1])
    store.append_history("final.h", *[changes.where(F.col("k") % 5 == i) for i in range(5)])
    assert len(list((tmp_path / "final/h/store_version=2").rglob("*.parquet"))) == 2
    assert sorted((r.k, r.w) for r in store.read_open("final.h").collect()) == [(k, "y") for k in range(50)]
    assert store.read_history("final.h").count() == 100
