"""Staging, streaming and warehouse runs over several days."""

import datetime as dt
import shutil
from pathlib import Path

import pytest
from failures import JOB_FAILURE
from fleet import ROWS, frames
from pyspark.sql import functions as F

from skyledger.daily import run_day
from skyledger.operators.quality import RuleBroken
from skyledger.plans.staging import load_profile, load_table, load_waves, run_staging, run_status, staging_frames, upsert_table
from skyledger.plans.warehouse import TARGETS, WAVES, _slices, run_warehouse
from skyledger.schemas import LOAD_ORDER, TABLES
from skyledger.session import scratch_path, scratch_root
from skyledger.sources.extract import parquet_source
from skyledger.sources.landing import landing_path, to_landing, write_csv
from skyledger.sources.store import Store
from skyledger.streaming.landings import stream_daily_landings

DAY1, DAY2, DAY3 = (dt.datetime(2024, 1, day, 1) for day in (15, 16, 17))
SPAN = (dt.date(2024, 1, 1), dt.date(2024, 1, 31))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def changed(name, key, **new):
    column = TABLES[name].key[0]
    return {**ROWS, name: [dict(r, **new) if r[column] == key else r for r in ROWS[name]]}


@pytest.fixture(scope="module")
def two_days(spark, tmp_path_factory):
    """A full day, then a day on which one aircraft and one flight change; bookings do not."""
    root = tmp_path_factory.mktemp("two")
    store, landing = Store(spark, f"{root}/store"), f"{root}/landing"
    first = run_staging(store, frames(spark, with_ids=False).get, landing, "2024-01-15", DAY1)
    run_warehouse(store, DAY1, span=SPAN)
    stamp = dt.datetime(2024, 1, 15, 23, 59, 59)
    day2 = changed("aircrafts_data", "CN1", range=1300, updated_at=stamp)
    day2 = {**day2, "flights": changed("flights", 3, status="Arrived", updated_at=stamp)["flights"]}
    second = run_staging(store, frames(spark, day2, with_ids=False).get, landing, "2024-01-16", DAY2, incremental=True)
    run_warehouse(store, DAY2, span=SPAN)
    return store, landing, first, second


def test_first_run_loads_everything(spark, two_days):
    _, _, first, _ = two_days
    got = {(r["table"], r["step"]): (r["status"], r["rows"]) for r in first.collect()}
    assert got == {(t, s): ("success", len(ROWS[t])) for t in TABLES for s in ("extract", "load")}


def test_second_run_skips_what_did_not_change(spark, two_days):
    store, landing, _, second = two_days
    got = {(r["table"], r["step"]): (r["status"], r["rows"]) for r in second.collect()}
    for table in TABLES:
        want = ("success", 1) if table in ("aircrafts_data", "flights") else ("skipped", 0)
        assert got[table, "extract"] == got[table, "load"] == want
    assert store.versions("stg.bookings") == [1] and store.versions("stg.flights") == [1, 2]
    assert run_status(store).count() == 32


def test_upsert_keeps_ids_and_takes_new_values(spark, two_days):
    store, *_ = two_days
    want = {r["aircraft_code"]: r["id"] for r in frames(spark)["aircrafts_data"].collect()}
    got = {r["aircraft_code"]: r for r in store.read("stg.aircrafts_data").collect()}
    assert {k: r["id"] for k, r in got.items()} == want
    assert got["CN1"]["range"] == 1300 and got["773"]["range"] == 11100


def test_histories(spark, two_days):
    store, *_ = two_days
    aircraft = store.read_history("final.dim_aircrafts")
    got = [(r["range"], r["dbt_valid_from"], r["dbt_valid_to"]) for r in aircraft.where("aircraft_nk = 'CN1'").collect()]
    assert sorted(got, key=str) == [(1200, DAY1, DAY2), (1300, DAY2, None)]
    assert aircraft.where("aircraft_nk = '773'").count() == 1
    passes = store.read_history("final.fct_boarding_pass").where("flight_id = 3")
    assert sorted((r["status"], r["dbt_valid_to"]) for r in passes.collect()) == [("Arrived", None), ("Departed", DAY2)]
    assert store.read_history("final.fct_booking_ticket").count() == len(
        [s for s in ROWS["ticket_flights"] if s["flight_id"] in (1, 4, 6) and s["ticket_no"] != "0005432000990"]
    )
    activity = store.read_history("final.fct_flight_activity")
    assert dict(activity.dtypes)["delay_departure"].startswith("interval")
    for name, target in TARGETS.items():
        opened = store.read_open(f"final.{name}")
        assert opened.groupBy(*target.key).count().where("count > 1").isEmpty(), name


def test_facts_in_slices_are_the_same(spark, two_days, tmp_path):
    """With buckets of a byte the staging tables count as large, so the facts of segments are made slice by slice."""
    whole, facts = two_days[0], ("fct_boarding_pass", "fct_booking_ticket")
    shutil.copytree(f"{whole.root}/stg", tmp_path / "stg")
    store = Store(spark, str(tmp_path), bucket_bytes=1)
    parts = [{r[0] for r in part(store.read("stg.tickets")).select("ticket_no").collect()} for part in _slices(store, "ticket_no")]
    assert len(parts) == 2 and all(parts) and not parts[0] & parts[1]
    assert parts[0] | parts[1] == {r["ticket_no"] for r in ROWS["tickets"]} and len(_slices(whole, "ticket_no")) == 1
    names = ("dim_aircrafts", "dim_airport", "dim_passenger", *facts)
    run_warehouse(store, DAY2, span=SPAN, names=names)
    plain = lambda df: rows(df.drop("dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"))
    for name in facts:
        assert plain(store.read_open(f"final.{name}")) == plain(whole.read_open(f"final.{name}")) != []
    batch = store.read("stg.flights").where("flight_id = 3").select("flight_id", F.lit("Cancelled").alias("status"))
    upsert_table(Store(spark, str(tmp_path)), TABLES["flights"], batch, DAY3)
    run_warehouse(store, DAY3, span=SPAN, names=names)
    passes = store.read_history("final.fct_boarding_pass")
    got = {(r["status"], r["dbt_valid_to"]) for r in passes.where("flight_id = 3").collect()}
    assert got == {("Arrived", DAY3), ("Cancelled", None)} and store.versions("final.fct_boarding_pass") == [1, 2]
    assert plain(passes.where("flight_id <> 3")) == plain(whole.read_open("final.fct_boarding_pass").where("flight_id <> 3"))


def test_large_facts_do_not_shuffle_at_once():
    assert not any({"fct_boarding_pass", "fct_booking_ticket"} <= set(wave) for wave in WAVES)
    assert sorted(name for wave in WAVES for name in wave) == sorted(TARGETS)


def test_scratch_of_a_load_goes_with_it(spark, tmp_path):
    left = lambda: {p for name in ("batch", "entries") for p in Path(scratch_root(spark)).glob(f"run-*/{name}")}
    before, store = left(), Store(spark, str(tmp_path))
    assert upsert_table(store, TABLES["flights"], frames(spark)["flights"], DAY1, rules=False)
    assert left() == before and store.buckets("stg.flights", "flight_no-scheduled_departure")


def test_passenger_repeated_by_natural_key_fails_its_snapshot(spark, two_days):
    store, *_ = two_days
    with pytest.raises(JOB_FAILURE, match="more than one row"):
        run_warehouse(
            store, DAY2, versions="all", passenger_join="natural", span=SPAN, names=("fct_booking_ticket",)
        )


def test_load_needs_a_successful_extract(spark, two_days):
    store, landing, *_ = two_days
    status = load_table(store, TABLES["flights"], landing, "2024-02-01", DAY2)
    assert status[2] == "skipped" and store.versions("stg.flights") == [1, 2]


BAD = {
    "flights": (
        dict(ROWS["flights"][1], flight_id=100, flight_no="PG0001", scheduled_departure=ROWS["flights"][0]["scheduled_departure"]),
        "unique_flight_no_scheduled_departure",
    ),
    "ticket_flights": (dict(ROWS["ticket_flights"][0], flight_id=77), "flight_id_in_flights"),
    "seats": (dict(ROWS["seats"][0], fare_conditions="Roof"), "fare_known"),
    "aircrafts_data": (dict(ROWS["aircrafts_data"][0], model=None), "not_null_model"),
}


@pytest.mark.parametrize("name", list(BAD))
def test_a_batch_that_breaks_a_rule_changes_nothing(spark, two_days, name):
    """The bad row clashes with rows loaded before, refers to none, or is bad by itself."""
    store, *_ = two_days
    row, rule = BAD[name]
    before, versions = rows(store.read(f"stg.{name}")), store.versions(f"stg.{name}")
    batch = frames(spark, {name: [row]}, with_ids=False)[name]
    with pytest.raises(RuleBroken, match=rule):
        upsert_table(store, TABLES[name], batch, DAY2)
    assert rows(store.read(f"stg.{name}")) == before and store.versions(f"stg.{name}") == versions


def test_rows_loaded_earlier_are_not_tested_again(spark, tmp_path):
    store, table = Store(spark, str(tmp_path)), TABLES["aircrafts_data"]
    bad = [dict(ROWS["aircrafts_data"][0], range=0)]
    upsert_table(store, table, frames(spark, {table.name: bad}, with_ids=False)[table.name], DAY1, rules=False)
    good = frames(spark, {table.name: ROWS[table.name][1:2]}, with_ids=False)[table.name]
    upsert_table(store, table, good, DAY2)
    assert store.versions("stg.aircrafts_data") == [1, 2]


def test_load_order_puts_parents_first():
    names = [t.name for t in LOAD_ORDER]
    for table in LOAD_ORDER:
        for ref in table.references:
            assert names.index(ref.parent) < names.index(table.name)


def test_batch_without_some_columns_keeps_them(spark, tmp_path):
    store, table = Store(spark, f"{tmp_path}/s"), TABLES["aircrafts_data"]
    full = frames(spark, with_ids=False)["aircrafts_data"]
    run_staging(store, {"aircrafts_data": full}.get, f"{tmp_path}/l", "2024-01-15", DAY1, tables=["aircrafts_data"], rules=False)
    part = full.where("aircraft_code = 'CN1'").select("aircraft_code", F.lit(7).alias("range"))
    run_staging(store, {"aircrafts_data": part}.get, f"{tmp_path}/l", "2024-01-16", DAY2, tables=["aircrafts_data"])
    got = store.read(f"stg.{table.name}").where("aircraft_code = 'CN1'").first()
    assert got["range"] == 7 and got["model"] == '{"en":"Cessna 208"}' and got["id"]


def test_json_key_order_makes_no_new_version(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    swapped = {**ROWS, "aircrafts_data": [dict(r, model='{"ru":"B", "en":"Boeing 777"}') if r["aircraft_code"] == "773" else r for r in ROWS["aircrafts_data"]]}
    for ds, at, data in (("2024-01-15", DAY1, ROWS), ("2024-01-16", DAY2, swapped)):
        source = frames(spark, data, with_ids=False)
        tables = ["aircrafts_data", "airports_data", "flights", "bookings"]
        run_staging(store, source.get, f"{tmp_path}/l", ds, at, tables=tables, rules=False)
        run_warehouse(store, at, span=SPAN, names=("dim_aircrafts",))
    assert store.read_history("final.dim_aircrafts").count() == 3


def test_stream_catches_up_on_missed_days(spark, tmp_path):
    store, table, landing = Store(spark, f"{tmp_path}/s"), TABLES["bookings"], f"{tmp_path}/l"
    base = frames(spark, with_ids=False)["bookings"]

    def land(ds, df):
        write_csv(to_landing(df, table), landing_path(landing, "bookings", True, ds))

    def run():
        stream_daily_landings(store, table, landing, f"{tmp_path}/progress", DAY1).awaitTermination()

    raised = lambda n: base.where("book_ref = '00000A'").withColumn("total_amount", (F.col("total_amount") + n).cast("decimal(10,2)"))
    land("2024-01-12", base)
    land("2024-01-13", raised(1))
    run()
    assert {r["book_ref"]: float(r["total_amount"]) for r in store.read("stg.bookings").collect()} == {"00000A": 301.0, "00000B": 12.5, "00000C": 9.99}
    land("2024-01-14", raised(2))
    land("2024-01-15", raised(3))
    run()
    assert float(store.read("stg.bookings").where("book_ref = '00000A'").first()["total_amount"]) == 303.0
    seen = store.versions("stg.bookings")
    run()
    assert store.versions("stg.bookings") == seen


def test_one_day_end_to_end(spark, tmp_path):
    for name, df in frames(spark, with_ids=False).items():
        df.write.parquet(f"{tmp_path}/source/{name}")
    status = run_day(
        spark, f"{tmp_path}/lake", parquet_source(spark, f"{tmp_path}/source"), "2024-01-15", DAY1,
        zone="Asia/Jakarta", passenger_join="surrogate",
    )
    assert {r["status"] for r in status.collect()} == {"success"}
    store = Store(spark, f"{tmp_path}/lake/tables")
    activity = store.read_history("final.fct_flight_activity")
    assert {r["flight_nk"] for r in activity.collect()} == {1, 4, 6}
    first = activity.where("flight_nk = 1").first()
    assert (first["scheduled_departure_date_local"], first["scheduled_departure_date_utc"]) == (20240116, 20240115)


def test_scratch_is_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x")
    assert shared is None or path.startswith(shared)


def test_a_table_without_any_load_is_empty(spark, tmp_path):
    given = {n: df for n, df in frames(spark, with_ids=False).items() if n != "boarding_passes"}
    store = Store(spark, f"{tmp_path}/store")
    for name, df in given.items():
        store.write(f"stg.{name}", df)
    passes = staging_frames(store)["boarding_passes"]
    assert passes.columns == TABLES["boarding_passes"].schema.names and passes.isEmpty()


def test_load_waves():
    names = [[t.name for t in wave] for wave in load_waves(TABLES)]
    assert names == [
        ["aircrafts_data", "airports_data", "bookings"], ["flights", "seats", "tickets"], ["ticket_flights"], ["boarding_passes"]
    ]
    assert [[t.name for t in wave] for wave in load_waves(["tickets", "seats"])] == [["seats", "tickets"]]


@pytest.mark.parametrize("on_failure", ["record", "raise"])
def test_a_failure_stops_its_dependents_only(spark, tmp_path, on_failure):
    """A seat of an unknown class fails its load; a source that cannot be read fails its extract."""
    bad = frames(spark, {**ROWS, "seats": [dict(r, fare_conditions="Roof") for r in ROWS["seats"]]}, with_ids=False)

    def source(name):
        if name == "tickets":
            raise OSError("no such table")
        return bad[name]

    store = Store(spark, f"{tmp_path}/s")
    run = lambda: run_staging(store, source, f"{tmp_path}/l", "2024-01-15", DAY1, on_failure=on_failure)
    if on_failure == "raise":
        with pytest.raises(OSError, match="no such table"):
            run()
    else:
        run()
    got = {(r["table"], r["step"]): r["status"] for r in run_status(store).collect()}
    assert got["tickets", "extract"] == got["seats", "load"] == "failed"
    assert {t for (t, step), s in got.items() if s == "blocked"} == {"ticket_flights", "boarding_passes"}
    assert {t for (t, step), s in got.items() if step == "load" and s == "success"} == {"aircrafts_data", "airports_data", "bookings", "flights"}
    assert got["tickets", "load"] == "skipped" and not store.exists("stg.seats")


def test_profile_of_an_extract(spark, two_days):
    store, *_ = two_days
    got = {(r["table"], r["column"]): r for r in load_profile(store).where(F.col("run_ts") == F.lit(DAY1)).collect()}
    assert {t for t, _ in got} == set(TABLES)
    row = got["flights", "actual_departure"]
    missing = sum(r.get("actual_departure") is None for r in ROWS["flights"])
    assert (row["rows"], row["nulls"]) == (len(ROWS["flights"]), missing)
    fares = [r["fare_conditions"] for r in ROWS["seats"]]
    row = got["seats", "fare_conditions"]
    assert (row["low"], row["high"], row["distinct_values"]) == (min(fares), max(fares), len(set(fares)))


def test_a_day_that_lands_late_changes_nothing_newer(spark, tmp_path):
    store, table, landing = Store(spark, f"{tmp_path}/s"), TABLES["bookings"], f"{tmp_path}/l"
    base = frames(spark, with_ids=False)["bookings"]
    stamp = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    newer = base.where("book_ref = '00000A'").withColumns({"total_amount": F.lit(5).cast("decimal(10,2)"), "updated_at": stamp})
    for ds, df in (("2024-01-21", newer), ("2024-01-15", base), ("2024-01-22", newer.drop("total_amount"))):
        write_csv(to_landing(df, table), landing_path(landing, "bookings", True, ds))
        stream_daily_landings(store, table, landing, f"{tmp_path}/progress", DAY1, rules=False).awaitTermination()
        got = {r["book_ref"]: float(r["total_amount"]) for r in store.read("stg.bookings").collect()}
        assert got["00000A"] == 5.0
    assert got == {"00000A": 5.0, "00000B": 12.5, "00000C": 9.99} and store.versions("stg.bookings") == [1, 2, 3]
