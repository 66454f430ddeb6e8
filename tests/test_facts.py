"""Dimensions and facts on the small airline, against row-by-row Python."""

import datetime as dt

import pytest
from fleet import ROWS, frames
from pyspark.sql import functions as F

from skyledger.operators.calendar import add_roles, dim_date, dim_date_over, dim_time
from skyledger.operators.snapshot import snapshot_check
from skyledger.plans import dimensions, facts

ZONES = {"UTC": dt.timezone.utc, "Asia/Jakarta": dt.timezone(dt.timedelta(hours=7))}
SPAN = (dt.date(2024, 1, 1), dt.date(2024, 1, 31))


@pytest.fixture(scope="module")
def stg(spark):
    return {name: df.cache() for name, df in frames(spark).items()}


@pytest.fixture(scope="module")
def dims(spark, stg):
    dims = {"dim_date": dim_date(spark, *SPAN), "dim_time": dim_time(spark)}
    dims["dim_aircrafts"] = dimensions.dim_aircrafts(stg)
    dims["dim_airport"] = dimensions.dim_airport(stg)
    dims["dim_passenger"] = dimensions.dim_passenger(stg)
    return {name: df.cache() for name, df in dims.items()}


@pytest.fixture(scope="module")
def ids(stg):
    keys = {"aircrafts_data": "aircraft_code", "airports_data": "airport_code", "tickets": "ticket_no"}
    return {r[k]: r["id"] for name, k in keys.items() for r in stg[name].collect()}


def role(name, ts, zone):
    """Local and UTC day and second, or None when the time is missing or not whole."""
    if ts is None or ts.microsecond:
        return None
    out = {}
    for label, where in (("local", ZONES[zone]), ("utc", dt.timezone.utc)):
        t = ts.astimezone(where)
        out[f"{name}_date_{label}"] = t.year * 10000 + t.month * 100 + t.day
        out[f"{name}_time_{label}"] = t.hour * 3600 + t.minute * 60 + t.second
    return out


def roles(row, names, zone):
    parts = [role(n, row[n], zone) for n in names]
    return None if None in parts else {k: v for p in parts for k, v in p.items()}


def places(flight, ids):
    return {c: ids[flight[c]] for c in ("departure_airport", "arrival_airport", "aircraft_code")}


def collected(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: repr(sorted(r.items(), key=str)))


def in_order(rows):
    return sorted(rows, key=lambda r: repr(sorted(r.items(), key=str)))


def test_dim_aircrafts(stg, ids):
    got = {r["aircraft_nk"]: tuple(r) for r in dimensions.dim_aircrafts(stg).collect()}
    assert got["CN1"] == (ids["CN1"], "CN1", '{"en":"Cessna 208"}', 1200) and len(got) == 3


def test_dim_airport_takes_the_english_city(stg):
    df = dimensions.dim_airport(stg)
    assert df.columns == ["airport_id", "airport_nk", "airport_name", "city", "coordinates", "timezone"]
    got = {r["airport_nk"]: (r["city"], r["airport_name"], tuple(r["coordinates"])) for r in df.collect()}
    assert got["CGK"] == ('A "q", b', '{"en":"Jakarta"}', (106.65, -6.125))
    assert got["DPS"][0] is None


def test_dim_passenger_has_a_row_per_ticket(stg, ids):
    got = {r["passenger_id"]: tuple(r)[1:] for r in dimensions.dim_passenger(stg).collect()}
    assert got[ids["0005432000987"]] == ("8149 604011", "ANA, P", "+62", "a@example.org")
    assert got[ids["0005432000988"]] == ("8149 604011", "ANA, P", None, None)
    assert got[ids["0005432000989"]][2:] == ("+1", None) and len(got) == 4


def test_dim_seat_sees_every_version_of_its_aircraft(spark, stg):
    one = dimensions.dim_aircrafts(stg)
    history = snapshot_check(None, one, ["aircraft_id"], dt.datetime(2024, 1, 1))
    changed = one.withColumn("range", F.when(F.col("aircraft_nk") == "773", 1).otherwise(F.col("range")))
    history = snapshot_check(history, changed, ["aircraft_id"], dt.datetime(2024, 1, 2))
    dims = {"dim_aircrafts": history}
    assert dimensions.dim_seat(stg, {"dim_aircrafts": one}).count() == 5
    assert dimensions.dim_seat(stg, dims, versions="all").count() == 8
    assert dimensions.dim_seat(stg, dims).count() == 5


@pytest.mark.parametrize("zone", list(ZONES))
def test_seat_occupied_daily(stg, dims, ids, zone):
    want = []
    for f in ROWS["flights"]:
        taken = [p for p in ROWS["boarding_passes"] if p["flight_id"] == f["flight_id"]]
        seats = [s for s in ROWS["seats"] if s["aircraft_code"] == f["aircraft_code"]]
        if f["status"] != "Arrived" or not taken or not seats:
            continue
        day = f["actual_departure"].astimezone(ZONES[zone])
        want.append(
            {"date_flight": int(day.strftime("%Y%m%d")), "flight_nk": f["flight_id"], "flight_no": f["flight_no"],
             **places(f, ids), "status": "Arrived", "total_seat": len(seats), "seat_occupied": len(taken),
             "empty_seats": len(seats) - len(taken)}
        )
    got = collected(facts.fct_seat_occupied_daily(stg, dims, zone))
    assert got == in_order(want)
    assert {r["flight_nk"] for r in got} == {1, 5}


def activity(ids, zone):
    for f in ROWS["flights"]:
        times = roles(f, (*facts.PLANNED, *facts.FLOWN), zone)
        if times is not None:
            yield {
                "flight_nk": f["flight_id"], "flight_no": f["flight_no"], **times, **places(f, ids), "status": f["status"],
                "delay_departure": f["actual_departure"] - f["scheduled_departure"],
                "delay_arrival": f["actual_arrival"] - f["scheduled_arrival"],
                "travel_time": f["actual_arrival"] - f["actual_departure"],
            }


@pytest.mark.parametrize("zone", list(ZONES))
def test_flight_activity(stg, dims, ids, zone):
    got = collected(facts.fct_flight_activity(stg, dims, zone))
    assert got == in_order(activity(ids, zone))
    assert {r["flight_nk"]: r["delay_departure"] for r in got}[1] == dt.timedelta(minutes=-2)
    assert {r["flight_nk"] for r in got} == {1, 4, 6}


def test_truncation_keeps_flights_with_fractions(stg, dims):
    got = facts.fct_flight_activity(stg, dims, truncate=True)
    assert {r["flight_nk"] for r in got.collect()} == {1, 4, 5, 6}


@pytest.mark.parametrize("zone", list(ZONES))
def test_boarding_pass(stg, dims, ids, zone):
    flights = {f["flight_id"]: f for f in ROWS["flights"]}
    tickets = {t["ticket_no"]: t for t in ROWS["tickets"]}
    fares = {(s["ticket_no"], s["flight_id"]): s["fare_conditions"] for s in ROWS["ticket_flights"]}
    want = []
    for p in ROWS["boarding_passes"]:
        f = flights[p["flight_id"]]
        want.append(
            {"ticket_no": p["ticket_no"], "book_ref": tickets[p["ticket_no"]]["book_ref"],
             "passenger_id": ids[p["ticket_no"]], "flight_id": p["flight_id"], "flight_no": f["flight_no"],
             "boarding_no": p["boarding_no"], **roles(f, facts.PLANNED, zone), **places(f, ids), "status": f["status"],
             "fare_conditions": fares[p["ticket_no"], p["flight_id"]], "seat_no": p["seat_no"]}
        )
    got = collected(facts.fct_boarding_pass(stg, dims, zone))
    assert got == in_order(want)
    assert 2 in {r["flight_id"] for r in got}  # planned flights stay in


@pytest.mark.parametrize("zone,join", [("UTC", "natural"), ("Asia/Jakarta", "natural"), ("Asia/Jakarta", "surrogate")])
def test_booking_ticket(stg, dims, ids, zone, join):
    flights = {f["flight_id"]: f for f in ROWS["flights"]}
    bookings = {b["book_ref"]: b for b in ROWS["bookings"]}
    want = []
    for s in ROWS["ticket_flights"]:
        t = next(t for t in ROWS["tickets"] if t["ticket_no"] == s["ticket_no"])
        b, f = bookings[t["book_ref"]], flights[s["flight_id"]]
        booked, flown = role("book", b["book_date"], zone), roles(f, (*facts.PLANNED, *facts.FLOWN), zone)
        same = [p for p in ROWS["tickets"] if p["passenger_id"] == t["passenger_id"]] if join == "natural" else [t]
        if booked is None or flown is None:
            continue
        want += [
            {"book_nk": b["book_ref"], **booked, "total_amount": b["total_amount"], "ticket_no": t["ticket_no"],
             "passenger_id": ids[p["ticket_no"]], "flight_nk": s["flight_id"], "fare_conditions": s["fare_conditions"],
             "amount": s["amount"], "flight_no": f["flight_no"], **flown, **places(f, ids), "status": f["status"]}
            for p in same
        ]
    df = facts.fct_booking_ticket(stg, dims, zone, passenger_join=join)
    assert len(df.columns) == 32
    got = collected(df)
    assert got == in_order(want)
    repeated = [r for r in got if r["ticket_no"] == "0005432000987" and r["flight_nk"] == 1]
    assert len(repeated) == (2 if join == "natural" else 1)


def test_column_order_of_the_facts(stg, dims):
    assert facts.fct_flight_activity(stg, dims).columns[:4] == [
        "flight_nk", "flight_no", "scheduled_departure_date_local", "scheduled_departure_date_utc",
    ]
    assert len(facts.fct_flight_activity(stg, dims).columns) == 25
    assert len(facts.fct_boarding_pass(stg, dims).columns) == 20
    assert facts.fct_boarding_pass(stg, dims).columns[-2:] == ["fare_conditions", "seat_no"]
    assert len(facts.fct_seat_occupied_daily(stg, dims).columns) == 10


def test_changed_dimension_doubles_facts_unless_current(stg, dims):
    aircraft = dimensions.dim_aircrafts(stg)
    history = snapshot_check(None, aircraft, ["aircraft_id"], dt.datetime(2024, 1, 1))
    changed = aircraft.withColumn("range", F.col("range") + 1)
    history = snapshot_check(history, changed, ["aircraft_id"], dt.datetime(2024, 1, 2))
    dims = {**dims, "dim_aircrafts": history}
    assert facts.fct_flight_activity(stg, dims, versions="all").count() == 6
    assert facts.fct_flight_activity(stg, dims).count() == 3


def test_places_as_of_departure(spark, stg, dims):
    """An airport that gets another id: each flight has the one of its day, the first one for earlier days."""
    airports = dimensions.dim_airport(stg)
    cut = dt.datetime(2024, 1, 15, 12)
    versions = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(a).alias("f"), F.lit(b).alias("t")) for i, a, b in (
        ("/1", dt.datetime(2024, 1, 15), cut), ("/2", cut, dt.datetime(2030, 1, 1)),
    )]))
    history = airports.withColumn("v", versions).withColumns(
        {
            "airport_id": F.concat("airport_nk", "v.i"),
            "dbt_valid_from": F.col("v.f").cast("timestamp_ntz"),
            "dbt_valid_to": F.col("v.t").cast("timestamp_ntz"),
        }
    ).drop("v")
    craft = dims["dim_aircrafts"].withColumns({c: F.lit(None).cast("timestamp_ntz") for c in ("dbt_valid_from", "dbt_valid_to")})
    got = facts.fct_flight_activity(stg, {**dims, "dim_airport": history, "dim_aircrafts": craft}, versions="as_of")
    found = {r.flight_nk: (r.departure_airport, r.arrival_airport) for r in got.collect()}
    want = {}
    for r in facts.fct_flight_activity(stg, dims).collect():
        row = next(x for x in ROWS["flights"] if x["flight_id"] == r.flight_nk)
        part = "/2" if row["actual_departure"].replace(tzinfo=None) >= cut else "/1"
        want[r.flight_nk] = (row["departure_airport"] + part, row["arrival_airport"] + part)
    assert found == want and len({x[-1] for pair in want.values() for x in pair}) == 2


def test_days_outside_the_calendar_drop(spark, stg, dims):
    short = {**dims, "dim_date": dim_date(spark, dt.date(2024, 1, 15), dt.date(2024, 1, 15))}
    assert facts.fct_seat_occupied_daily(stg, short).count() == 1


def test_calendars(spark, stg):
    days = dim_date(spark, dt.date(2024, 2, 28), dt.date(2024, 3, 1)).collect()
    assert [tuple(r) for r in days] == [
        (20240228, dt.date(2024, 2, 28)), (20240229, dt.date(2024, 2, 29)), (20240301, dt.date(2024, 3, 1)),
    ]
    times = dim_time(spark)
    assert times.count() == 86_400
    assert times.where("time_id = 36672").first()["time_actual"] == "10:11:12"
    spanned = dim_date_over(stg["flights"], "scheduled_departure", "actual_arrival")
    low, high = spanned.selectExpr("min(date_actual)", "max(date_actual)").first()
    assert (low, high) == (dt.date(2024, 1, 13), dt.date(2024, 1, 21))
    assert dim_date_over(stg["flights"].where("1 = 0"), "scheduled_departure").isEmpty()


def test_time_dimension_of_finer_grain(spark):
    dates = dim_date(spark, *SPAN)
    times = spark.createDataFrame([(1, "10:11:12"), (2, "10:11:12.5")], "time_id int, time_actual string")
    ts = spark.sql("SELECT TIMESTAMP '2024-01-15 10:11:12.5' AS ts")
    assert add_roles(ts, {"r": "ts"}, dates, times).first()["r_time_utc"] == 2
