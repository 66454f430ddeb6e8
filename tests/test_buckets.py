"""Tables in key buckets: what a batch writes, and unique keys seen through their index."""

import datetime as dt
import random

import pytest
from failures import JOB_FAILURE
from fleet import ROWS, frames

from skyledger.operators.quality import RuleBroken
from skyledger.plans import staging
from skyledger.plans.staging import extract_table, upsert_table
from skyledger.schemas import TABLES
from skyledger.sources.landing import read_csv
from skyledger.sources.store import Store

AT = dt.datetime(2024, 1, 15, 1)
BOOKINGS, FLIGHTS = TABLES["bookings"], TABLES["flights"]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def bookings(spark, amounts):
    data = [(f"{k:06d}", dt.datetime(2024, 1, 1), v) for k, v in amounts.items()]
    df = spark.createDataFrame(data, "book_ref string, book_date timestamp, total_amount double")
    return df.withColumn("total_amount", df["total_amount"].cast("decimal(10,2)"))


def bucket_files(root):
    return {str(p.relative_to(root)) for p in root.glob("stg/*/store_version=*/**/store_bucket=*/*.parquet")}


def amounts(store):
    return {int(r["book_ref"]): float(r["total_amount"]) for r in store.read("stg.bookings").collect()}


@pytest.fixture
def many(spark, tmp_path):
    """Two hundred bookings in several buckets."""
    store = Store(spark, str(tmp_path), bucket_bytes=1000)
    upsert_table(store, BOOKINGS, bookings(spark, dict.fromkeys(range(200), 1.0)), AT)
    return store, tmp_path


def test_a_batch_of_one_row_writes_one_bucket(spark, many):
    store, root = many
    before = bucket_files(root)
    buckets = store.buckets("stg.bookings")
    assert buckets >= 4 and len(before) > 2
    ids = {r["book_ref"]: r["id"] for r in store.read("stg.bookings").collect()}
    for batch in ({17: 5.0}, {900: 7.0}):
        upsert_table(store, BOOKINGS, bookings(spark, batch), AT)
        fresh = bucket_files(root) - before
        assert len(fresh) == 1 and before < bucket_files(root)
        before = bucket_files(root)
    assert amounts(store) == {**dict.fromkeys(range(200), 1.0), 17: 5.0, 900: 7.0}
    after = {r["book_ref"]: r["id"] for r in store.read("stg.bookings").collect()}
    assert {k: after[k] for k in ids} == ids


def test_many_batches_as_row_by_row(spark, tmp_path):
    rng = random.Random(4)
    store, want = Store(spark, str(tmp_path), bucket_bytes=700), {}
    for size in (30, 5, 1, 60):
        batch = {rng.randrange(120): float(rng.randrange(100)) for _ in range(size)}
        assert upsert_table(store, BOOKINGS, bookings(spark, batch), AT) == len(batch)
        want.update(batch)
        assert amounts(store) == want
    store.drop_superseded("stg.bookings", keep=1)
    assert amounts(store) == want


def test_crowded_buckets_are_split(spark, many):
    store, root = many
    small = Store(spark, str(root), bucket_bytes=10)
    assert small.crowded("stg.bookings") > store.buckets("stg.bookings")
    upsert_table(small, BOOKINGS, bookings(spark, {3: 9.0}), AT)
    assert small.buckets("stg.bookings") >= 128
    assert amounts(small) == {**dict.fromkeys(range(200), 1.0), 3: 9.0}


def test_a_table_written_as_a_whole_is_taken_over(spark, tmp_path):
    store = Store(spark, str(tmp_path), bucket_bytes=1000)
    store.write("stg.flights", frames(spark)["flights"])
    clash = dict(ROWS["flights"][1], flight_id=100, flight_no="PG0001", scheduled_departure=ROWS["flights"][0]["scheduled_departure"])
    for name in ("aircrafts_data", "airports_data"):
        store.write(f"stg.{name}", frames(spark)[name])
    with pytest.raises(RuleBroken, match="unique_flight_no_scheduled_departure"):
        upsert_table(store, FLIGHTS, frames(spark, {"flights": [clash]}, with_ids=False)["flights"], AT)
    fine = frames(spark, {"flights": [dict(clash, flight_no="PG0100")]}, with_ids=False)["flights"]
    upsert_table(store, FLIGHTS, fine, AT)
    assert store.read("stg.flights").count() == len(ROWS["flights"]) + 1
    store.write("stg.flights", frames(spark)["flights"])
    assert store.buckets("stg.flights") == 0 and store.read("stg.flights").count() == len(ROWS["flights"])


def test_empty_batch_and_failed_batch_change_nothing(spark, many):
    store, _ = many
    assert upsert_table(store, BOOKINGS, bookings(spark, {}).where("false"), AT) == 0
    twice = bookings(spark, {1: 2.0}).union(bookings(spark, {1: 3.0}))
    with pytest.raises(JOB_FAILURE, match="more than one row"):
        upsert_table(store, BOOKINGS, twice, AT)
    assert store.versions("stg.bookings") == [1] and amounts(store) == dict.fromkeys(range(200), 1.0)


PASSES = TABLES["boarding_passes"]


def passes(spark, values):
    schema = "ticket_no string, flight_id int, boarding_no int, seat_no string"
    return spark.createDataFrame([(t, f, n, s) for (t, f), (n, s) in values.items()], schema)


def index_rows(store, name):
    found = store.read_buckets("stg.boarding_passes", None, name)
    return set() if found is None else {(r["flight_id"], r[name.split("-")[1]], r["ticket_no"]) for r in found.collect()}


def test_unique_keys_over_many_batches(spark, tmp_path):
    """A seat may pass to another ticket in one batch or in two, and clashes with any row loaded before."""
    store = Store(spark, str(tmp_path), bucket_bytes=500)
    store.write("stg.ticket_flights", spark.createDataFrame([(t, f) for t in "abcdef" for f in (1, 2)], "ticket_no string, flight_id int"))
    held = {}

    def load(batch, clash=None):
        versions = store.versions("stg.boarding_passes")
        if clash:
            with pytest.raises(RuleBroken, match=clash):
                upsert_table(store, PASSES, passes(spark, batch), AT)
            assert store.versions("stg.boarding_passes") == versions
        else:
            upsert_table(store, PASSES, passes(spark, batch), AT)
            held.update(batch)
        seats = {(f, s, t) for (t, f), (n, s) in held.items() if s is not None}
        assert index_rows(store, "flight_id-seat_no") == seats
        assert index_rows(store, "flight_id-boarding_no") == {(f, n, t) for (t, f), (n, s) in held.items()}

    load({("a", 1): (1, "1A"), ("b", 1): (2, "1B"), ("a", 2): (1, "1A")})
    load({("c", 1): (3, "1A")}, clash="unique_flight_id_seat_no")
    load({("c", 1): (2, "1C")}, clash="unique_flight_id_boarding_no")
    load({("a", 1): (1, "1B"), ("b", 1): (2, "1A")})  # exchanged
    load({("a", 1): (1, "9A")})
    load({("c", 1): (3, "1B")})
    load({("c", 1): (3, "1B"), ("d", 1): (4, "1A")}, clash="unique_flight_id_seat_no")
    load({("d", 2): (7, "1A"), ("e", 2): (8, "1A")}, clash="unique_flight_id_seat_no")
    store.drop_superseded("stg.boarding_passes", keep=1)
    load({("f", 1): (9, "9A")}, clash="unique_flight_id_seat_no")
    load({("f", 1): (9, "9B")})


def test_first_batch_with_a_clash_leaves_no_table(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write("stg.ticket_flights", spark.createDataFrame([("a", 1), ("b", 1)], "ticket_no string, flight_id int"))
    with pytest.raises(RuleBroken, match="unique_flight_id_seat_no"):
        upsert_table(store, PASSES, passes(spark, {("a", 1): (1, "1A"), ("b", 1): (2, "1A")}), AT)
    assert not store.exists("stg.boarding_passes")


def test_a_large_bucket_is_dealt_over_tasks(spark, tmp_path, monkeypatch):
    """Its parts are files of one bucket; rows stay those of a row-by-row upsert."""
    monkeypatch.setattr(staging, "TASK_BYTES", 1000)
    # Kept apart, as it would be with parts of full size.
    monkeypatch.setattr(staging, "_by_bucket", lambda *a, known=staging._by_bucket: known(*a).repartition(8, staging.BUCKET, staging.PART))
    store = Store(spark, str(tmp_path))
    upsert_table(store, BOOKINGS, bookings(spark, dict.fromkeys(range(200), 1.0)), AT)
    upsert_table(store, BOOKINGS, bookings(spark, dict.fromkeys(range(100, 300), 2.0)), AT)
    assert store.buckets("stg.bookings") == 1
    assert len({f for f in bucket_files(tmp_path) if "store_version=2" in f}) > 1
    assert amounts(store) == {**dict.fromkeys(range(100), 1.0), **dict.fromkeys(range(100, 300), 2.0)}


def test_the_staged_batch_goes_once_it_is_loaded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "scratch_path", lambda _, name: f"{tmp_path}/scratch/{name}")
    upsert_table(Store(spark, f"{tmp_path}/store"), BOOKINGS, bookings(spark, {1: 1.0}), AT)
    assert not (tmp_path / "scratch" / "batch").exists()


def test_a_first_batch_is_tested_without_being_joined_with_itself(spark):
    after = passes(spark, {("a", 1): (1, "1A"), (None, 1): (2, "1B")})
    changed = staging.keyindex.changed_entries(None, after, None, ("flight_id", "seat_no"), PASSES.key)
    assert rows(changed) == [(True, 1, "1A", "a")]
    assert "Join" not in changed._jdf.queryExecution().optimizedPlan().toString()


def test_extracts_are_landed_compressed(spark, tmp_path):
    extract_table(frames(spark).get, FLIGHTS, str(tmp_path), "2024-01-15", AT)
    files = list((tmp_path / "full" / "flights").glob("part-*"))
    assert files and all(f.name.endswith(".csv.gz") for f in files)
    assert rows(read_csv(spark, f"{tmp_path}/full/flights", FLIGHTS.schema, FLIGHTS)) == rows(frames(spark)["flights"])
