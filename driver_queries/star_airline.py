"""The dimensions, facts and daily runs of the library over staging tables derived from the given ones."""

import datetime as dt

from pyspark.sql import functions as F

from driver_queries.airline import STAGING_SQL, staging, stored
from driver_queries.registry import query
from skyledger.operators import calendar
from skyledger.operators.quality import table_violations
from skyledger.plans import dimensions, facts
from skyledger.plans.staging import extract_tables, load_profile, record_profiles, run_staging
from skyledger.plans.warehouse import run_warehouse
from skyledger.schemas import TABLES
from skyledger.session import scratch_path
from skyledger.sources.dump import dump_source, write_dump
from skyledger.sources.extract import extract
from skyledger.sources.landing import daily_root, landing_path, read_csv, to_landing, write_csv
from skyledger.sources.store import Store
from skyledger.streaming.landings import stream_daily_landings

ZONE = "Asia/Jakarta"


_PLACES_AND_FLIGHTS = ("aircrafts_data", "airports_data", "flights")


def _warehouse(t, *names: str):
    """Staging tables and the dimensions and calendars over them."""
    stg = stored(t, staging(t, *names))
    dates = calendar.dim_date_over(stg["flights"], *facts.PLANNED, *facts.FLOWN, zone=ZONE)
    if "bookings" in names:
        dates = dates.union(calendar.dim_date_over(stg["bookings"], "book_date", zone=ZONE)).distinct()
    dims = stored(t, {"dim_date": dates.coalesce(1), "dim_time": calendar.dim_time(t.spark)})
    dims["dim_aircrafts"] = dimensions.dim_aircrafts(stg)
    dims["dim_airport"] = dimensions.dim_airport(stg)
    if "tickets" in names:
        dims["dim_passenger"] = dimensions.dim_passenger(stg)
    return stg, dims


def _roles(table: str, *roles: str) -> str:
    """Local (UTC+7) and UTC day and second of each timestamp."""
    out = []
    for role in roles:
        utc = f"{table}.{'book_date' if role == 'book' else role}"
        for label, ts in (("local", f"({utc} + INTERVAL 7 HOUR)"), ("utc", utc)):
            out.append(f"CAST(strftime({ts}, '%Y%m%d') AS INTEGER) AS {role}_date_{label}")
            seconds = f"hour({ts}) * 3600 + minute({ts}) * 60 + second({ts})"
            out.append(f"CAST({seconds} AS INTEGER) AS {role}_time_{label}")
    return ", ".join(out)


def _on_the_second(*columns: str) -> str:
    return " AND ".join(f"date_trunc('second', {c}) = {c}" for c in columns)


_PLACES = """
    JOIN airports_data dep ON dep.airport_code = f.departure_airport
    JOIN airports_data arr ON arr.airport_code = f.arrival_airport
    JOIN aircrafts_data craft ON craft.aircraft_code = f.aircraft_code
"""
_PLACE_IDS = "dep.id AS departure_airport, arr.id AS arrival_airport, craft.id AS aircraft_code"
_PLANNED = ("f.scheduled_departure", "f.scheduled_arrival")
_FLOWN = ("f.actual_departure", "f.actual_arrival")


@query(
    "dim_aircrafts",
    f"WITH {STAGING_SQL} SELECT id AS aircraft_id, aircraft_code AS aircraft_nk, model, range FROM aircrafts_data",
)
def dim_aircrafts(t):
    return dimensions.dim_aircrafts(staging(t, "aircrafts_data"))


@query(
    "dim_airport",
    f"""
    WITH {STAGING_SQL}
    SELECT id AS airport_id, airport_code AS airport_nk, airport_name, city->>'en' AS city,
           CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, timezone FROM airports_data
    """,
)
def dim_airport(t):
    return dimensions.dim_airport(staging(t, "airports_data")).select("*", "coordinates.x", "coordinates.y").drop("coordinates")


@query(
    "dim_passenger",
    f"WITH {STAGING_SQL} SELECT id AS passenger_id, passenger_id AS passenger_nk, passenger_name, phone, email FROM tickets",
)
def dim_passenger(t):
    return dimensions.dim_passenger(staging(t, "tickets"))


@query(
    "dim_seat",
    f"""
    WITH {STAGING_SQL}
    SELECT seats.id AS seat_id, aircrafts_data.id AS aircraft_id, seat_no, fare_conditions
    FROM seats JOIN aircrafts_data USING (aircraft_code)
    """,
)
def dim_seat(t):
    stg = staging(t, "seats", "aircrafts_data")
    return dimensions.dim_seat(stg, {"dim_aircrafts": dimensions.dim_aircrafts(stg)})


@query(
    "fct_seat_occupied_daily",
    f"""
    WITH {STAGING_SQL},
    taken AS (SELECT flight_id, count(seat_no) AS seat_occupied FROM flights JOIN boarding_passes USING (flight_id)
              WHERE status = 'Arrived' GROUP BY flight_id),
    room AS (SELECT aircraft_code, count(seat_no) AS total_seat FROM seats GROUP BY aircraft_code)
    SELECT CAST(strftime(f.actual_departure + INTERVAL 7 HOUR, '%Y%m%d') AS INTEGER) AS date_flight,
           f.flight_id AS flight_nk, f.flight_no, {_PLACE_IDS}, f.status, total_seat, seat_occupied,
           total_seat - seat_occupied AS empty_seats
    FROM flights f {_PLACES}
    JOIN taken ON taken.flight_id = f.flight_id
    JOIN room ON room.aircraft_code = f.aircraft_code
    WHERE f.actual_departure IS NOT NULL
    """,
)
def fct_seat_occupied_daily(t):
    stg, dims = _warehouse(t, *_PLACES_AND_FLIGHTS, "seats", "boarding_passes")
    return facts.fct_seat_occupied_daily(stg, dims, zone=ZONE)


_ACTIVITY_SQL = f"""
    SELECT f.flight_id AS flight_nk, f.flight_no,
           {_roles('f', 'scheduled_departure', 'scheduled_arrival')}, {_PLACE_IDS},
           {_roles('f', 'actual_departure', 'actual_arrival')}, f.status,
           date_diff('second', f.scheduled_departure, f.actual_departure) AS delay_departure,
           date_diff('second', f.scheduled_arrival, f.actual_arrival) AS delay_arrival,
           date_diff('second', f.actual_departure, f.actual_arrival) AS travel_time
    FROM flights f {_PLACES}
    WHERE {_on_the_second(*_PLANNED, *_FLOWN)}
"""
_DELAYS = ("delay_departure", "delay_arrival", "travel_time")


def _in_seconds(df):
    """Intervals as whole seconds, since SQL dialects differ in how they print them."""
    return df.withColumns({c: F.expr(f"timestampdiff(SECOND, TIMESTAMP '2000-01-01', TIMESTAMP '2000-01-01' + {c})") for c in _DELAYS})


@query("fct_flight_activity", f"WITH {STAGING_SQL} {_ACTIVITY_SQL}")
def fct_flight_activity(t):
    stg, dims = _warehouse(t, *_PLACES_AND_FLIGHTS)
    return _in_seconds(facts.fct_flight_activity(stg, dims, zone=ZONE))


@query(
    "fct_boarding_pass",
    f"""
    WITH {STAGING_SQL}
    SELECT tk.ticket_no, tk.book_ref, tk.id AS passenger_id, f.flight_id, f.flight_no, bp.boarding_no,
           {_roles('f', 'scheduled_departure', 'scheduled_arrival')}, {_PLACE_IDS},
           f.status, tf.fare_conditions, bp.seat_no
    FROM boarding_passes bp
    JOIN ticket_flights tf ON tf.ticket_no = bp.ticket_no AND tf.flight_id = bp.flight_id
    JOIN tickets tk ON tk.ticket_no = bp.ticket_no
    JOIN flights f ON f.flight_id = bp.flight_id {_PLACES}
    WHERE {_on_the_second(*_PLANNED)}
    """,
)
def fct_boarding_pass(t):
    stg, dims = _warehouse(t, *_PLACES_AND_FLIGHTS, "tickets", "ticket_flights", "boarding_passes")
    return facts.fct_boarding_pass(stg, dims, zone=ZONE)


def _booking_sql(trim: str = "") -> str:
    return f"""
    SELECT b.book_ref AS book_nk, {_roles('b', 'book')}, b.total_amount, tk.ticket_no, tk.id AS passenger_id,
           f.flight_id AS flight_nk, tf.fare_conditions, tf.amount, f.flight_no,
           {_roles('f', 'scheduled_departure', 'scheduled_arrival')}, {_PLACE_IDS}, f.status,
           {_roles('f', 'actual_departure', 'actual_arrival')}
    FROM bookings b
    JOIN tickets tk ON tk.book_ref = b.book_ref
    JOIN ticket_flights tf ON tf.ticket_no = tk.ticket_no
    JOIN flights f ON f.flight_id = tf.flight_id {_PLACES}
    WHERE f.actual_departure IS NOT NULL AND f.actual_arrival IS NOT NULL {trim}
    """


_EXACT = "AND " + _on_the_second("b.book_date", *_PLANNED, *_FLOWN)


@query("fct_booking_ticket", f"WITH {STAGING_SQL} {_booking_sql(_EXACT)}")
def fct_booking_ticket(t):
    stg, dims = _warehouse(t, *_PLACES_AND_FLIGHTS, "bookings", "tickets", "ticket_flights")
    return facts.fct_booking_ticket(stg, dims, zone=ZONE, passenger_join="natural")


@query("fct_booking_ticket_truncated", f"WITH {STAGING_SQL} {_booking_sql()}")
def fct_booking_ticket_truncated(t):
    """Times cut to whole seconds, so that no segment is lost to a fraction."""
    stg, dims = _warehouse(t, *_PLACES_AND_FLIGHTS, "bookings", "tickets", "ticket_flights")
    return facts.fct_booking_ticket(stg, dims, zone=ZONE, truncate=True, passenger_join="surrogate")


@query(
    "staging_rules",
    f"""
    WITH {STAGING_SQL}
    SELECT 'boarding_passes' AS "table", 'unique_flight_id_' || c AS rule, flight_id || '|' || v AS key, n AS rows
    FROM (SELECT 'boarding_no' AS c, flight_id, boarding_no::VARCHAR AS v, count(*) AS n FROM boarding_passes GROUP BY ALL
          UNION ALL
          SELECT 'seat_no', flight_id, seat_no, count(*) FROM boarding_passes GROUP BY ALL) u
    WHERE n > 1
    UNION ALL
    SELECT 'flights', 'unique_flight_no_scheduled_departure',
           flight_no || '|' || strftime(scheduled_departure, '%Y-%m-%d %H:%M:%S'), count(*)
    FROM flights GROUP BY flight_no, scheduled_departure HAVING count(*) > 1
    UNION ALL
    SELECT 'flights', 'aircraft_code_in_aircrafts_data', aircraft_code, count(*) FROM flights
    WHERE aircraft_code NOT IN (SELECT p_brand FROM part) GROUP BY aircraft_code
    """,
)
def staging_rules(t):
    """Every declared rule of every staging table."""
    stg = stored(t, staging(t))
    found = [table_violations(table, stg) for table in TABLES.values()]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


FIRST_RUN, SECOND_RUN = dt.datetime(2024, 1, 15, 1), dt.datetime(2024, 1, 16, 1)


def _next_day(t, tables):
    """Staging frames a day on, on which departed flights have arrived."""
    stg = staging(t, *tables)
    moved = F.col("status") == "Departed"
    stamp = F.lit("2024-01-15 09:00:00").cast("timestamp_ntz")
    stg["flights"] = stg["flights"].withColumns(
        {
            "updated_at": F.when(moved, stamp).otherwise(F.col("updated_at")),
            "status": F.when(moved, F.lit("Arrived")).otherwise(F.col("status")),
        }
    )
    return stg


def _two_days(t, *tables: str):
    """A full run and an incremental run a day later: store, and status of the second run.

    Rules are off: `staging_rules` shows which ones the derived rows break.
    """
    store = Store(t.spark, scratch_path(t.spark, "store"))
    landing = scratch_path(t.spark, "landing")
    run_staging(store, staging(t, *tables).get, landing, "2024-01-15", FIRST_RUN, tables=tables, rules=False)
    yield store
    yield run_staging(
        store, _next_day(t, tables).get, landing, "2024-01-16", SECOND_RUN, incremental=True, tables=tables, rules=False
    )


@query(
    "run_status",
    """
    SELECT s.step, s.tbl AS "table", CASE WHEN n > 0 THEN 'success' ELSE 'skipped' END AS status,
           CAST(n AS BIGINT) AS rows, DATE '2024-01-16' AS data_date
    FROM (SELECT 'flights' AS tbl, count(*) AS n FROM events WHERE event_type = 'view'
          UNION ALL SELECT 'bookings', 0) c
    JOIN (SELECT unnest(['extract', 'load']) AS step, unnest(['flights', 'flights']) AS tbl
          UNION ALL SELECT unnest(['extract', 'load']), 'bookings') s USING (tbl)
    """,
)
def run_status(t):
    """The second day touches some flights and no booking, so bookings are skipped."""
    _, status = _two_days(t, "flights", "bookings")
    return status.select("step", "table", "status", "rows", "data_date")


@query(
    "staging_cycle",
    f"""
    WITH {STAGING_SQL}
    SELECT flight_id, flight_no, scheduled_departure, scheduled_arrival, departure_airport, arrival_airport, aircraft_code,
           actual_departure, actual_arrival, CASE status WHEN 'Departed' THEN 'Arrived' ELSE status END AS status,
           CASE status WHEN 'Departed' THEN TIMESTAMP '2024-01-15 09:00:00' ELSE TIMESTAMP '2024-01-14 12:00:00' END AS updated_at
    FROM flights
    """,
)
def staging_cycle(t):
    """Flights after a full and an incremental day through CSV and upsert."""
    store, _ = _two_days(t, "flights")
    instants = (*facts.PLANNED, *facts.FLOWN)
    return (
        store.read("stg.flights")
        .drop("id", "created_at")
        .withColumns({c: F.col(c).cast("timestamp_ntz") for c in instants})
    )


@query(
    "landing_stream",
    f"""
    WITH {STAGING_SQL}
    SELECT book_ref, book_date, CAST(CASE WHEN o_orderstatus = 'F' THEN total_amount + 1 ELSE total_amount END AS DECIMAL(10, 2)) AS total_amount
    FROM bookings JOIN orders ON book_ref = lpad(o_orderkey::VARCHAR, 10, '0')
    """,
)
def landing_stream(t):
    """Two landed days read as a stream; the later day's amounts win."""
    table = TABLES["bookings"]
    store = Store(t.spark, scratch_path(t.spark, "store"))
    landing = scratch_path(t.spark, "landing")
    bookings = staging(t, "bookings")["bookings"]
    finished = t.orders.where("o_orderstatus = 'F'").select(F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("book_ref"))
    raised = bookings.join(finished, "book_ref", "left_semi").select(
        *[(F.col(c) + 1).cast("decimal(10,2)").alias(c) if c == "total_amount" else F.col(c) for c in bookings.columns]
    )
    for ds, rows in (("2024-01-15", bookings), ("2024-01-16", raised)):
        write_csv(to_landing(rows, table), landing_path(landing, table.name, incremental=True, ds=ds))
    stream = stream_daily_landings(store, table, landing, scratch_path(t.spark, "progress"), SECOND_RUN)
    stream.awaitTermination()
    return store.read("stg.bookings").select("book_ref", F.col("book_date").cast("timestamp_ntz").alias("book_date"), "total_amount")


@query(
    "warehouse_cycle",
    f"""
    WITH {STAGING_SQL}, activity AS ({_ACTIVITY_SQL}), v AS (
        SELECT activity.* EXCLUDE (status), status, TIMESTAMP '{FIRST_RUN}' AS dbt_valid_from,
               CASE WHEN status = 'Departed' THEN TIMESTAMP '{SECOND_RUN}' END AS dbt_valid_to FROM activity
        UNION ALL
        SELECT activity.* EXCLUDE (status), 'Arrived', TIMESTAMP '{SECOND_RUN}', NULL FROM activity WHERE status = 'Departed')
    SELECT *, md5(flight_nk || '|' || dbt_valid_from::VARCHAR) AS dbt_scd_id FROM v
    """,
)
def warehouse_cycle(t):
    """Two days of staging and warehouse; the history of flight activity after them."""
    names = ("dim_aircrafts", "dim_airport", "fct_flight_activity")
    days = _two_days(t, *_PLACES_AND_FLIGHTS, "bookings")
    store = next(days)
    run_warehouse(store, FIRST_RUN, ZONE, versions="all", passenger_join="natural", names=names)
    next(days)
    run_warehouse(store, SECOND_RUN, ZONE, versions="all", passenger_join="natural", names=names)
    return _in_seconds(store.read_history("final.fct_flight_activity")).drop("dbt_updated_at")


_DEPARTED = "status = 'Departed'"


def _kept(rows: str, key: str, value: str, moved: str = "false") -> str:
    """A first version of every row, and a second one of those whose flight moved."""
    return f"""
        SELECT {key} AS key, {value.format(status='status')} AS value, TIMESTAMP '{FIRST_RUN}' AS valid_from,
               CASE WHEN {moved} THEN TIMESTAMP '{SECOND_RUN}' END AS valid_to FROM {rows}
        UNION ALL
        SELECT {key}, {value.format(status="'Arrived'")}, TIMESTAMP '{SECOND_RUN}', NULL FROM {rows} WHERE {moved}
    """


@query(
    "two_days_as_shipped",
    f"""
    WITH {STAGING_SQL},
    seat AS (SELECT seats.id, aircrafts_data.id AS aircraft_id, seat_no, fare_conditions
             FROM seats JOIN aircrafts_data USING (aircraft_code)),
    pass AS (SELECT bp.*, f.status, tk.id AS passenger FROM boarding_passes bp
             JOIN ticket_flights tf ON tf.ticket_no = bp.ticket_no AND tf.flight_id = bp.flight_id
             JOIN tickets tk ON tk.ticket_no = bp.ticket_no
             JOIN flights f ON f.flight_id = bp.flight_id {_PLACES} WHERE {_on_the_second(*_PLANNED)}),
    booked AS ({_booking_sql(_EXACT)})
    SELECT 'dim_seat' AS "table", * FROM ({_kept('seat', 'id', "aircraft_id || '|' || seat_no || '|' || fare_conditions")})
    UNION ALL
    SELECT 'fct_boarding_pass', * FROM ({_kept(
        'pass', "ticket_no || '|' || flight_id || '|' || boarding_no", "passenger || '|' || {status}", _DEPARTED)})
    UNION ALL
    SELECT 'fct_booking_ticket', * FROM ({_kept(
        'booked', "book_nk || '|' || ticket_no || '|' || flight_nk", "passenger_id || '|' || {status}", _DEPARTED)})
    """,
)
def two_days_as_shipped(t):
    """Two days of staging and warehouse with no option but the zone; three of its histories after them."""
    days = _two_days(t, *_PLACES_AND_FLIGHTS, "bookings", "seats", "tickets", "ticket_flights", "boarding_passes")
    store = next(days)
    run_warehouse(store, FIRST_RUN, ZONE)
    next(days)
    run_warehouse(store, SECOND_RUN, ZONE)
    shown = {
        "dim_seat": (["seat_id"], ["aircraft_id", "seat_no", "fare_conditions"]),
        "fct_boarding_pass": (["ticket_no", "flight_id", "boarding_no"], ["passenger_id", "status"]),
        "fct_booking_ticket": (["book_nk", "ticket_no", "flight_nk"], ["passenger_id", "status"]),
    }
    parts = [
        store.read_history(f"final.{name}").select(
            F.lit(name).alias("table"),
            F.concat_ws("|", *key).alias("key"),
            F.concat_ws("|", *value).alias("value"),
            F.col("dbt_valid_from").alias("valid_from"),
            F.col("dbt_valid_to").alias("valid_to"),
        )
        for name, (key, value) in shown.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _land(t, landing: str, ds: str, rows) -> None:
    write_csv(to_landing(rows, TABLES["bookings"]), landing_path(landing, "bookings", incremental=True, ds=ds))


def _stream(t, store, landing: str, progress: str) -> None:
    stream_daily_landings(store, TABLES["bookings"], landing, progress, SECOND_RUN).awaitTermination()


def _booked(df):
    instant = F.col("book_date").cast("timestamp_ntz").alias("book_date")
    return df.select("book_ref", instant, "total_amount")


def _raised(t, bookings, by: int, status: str):
    """The bookings of orders with a status, raised and updated a day later."""
    chosen = t.orders.where(F.col("o_orderstatus") == status).select(F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("book_ref"))
    return bookings.join(chosen, "book_ref", "left_semi").withColumns(
        {
            "total_amount": (F.col("total_amount") + by).cast("decimal(10,2)"),
            "updated_at": F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"),
        }
    )


_BOOKED_SQL = "FROM bookings JOIN orders ON book_ref = lpad(o_orderkey::VARCHAR, 10, '0')"


@query(
    "landing_by_name",
    f"""
    WITH {STAGING_SQL},
    first AS (SELECT book_ref, book_date, total_amount {_BOOKED_SQL} WHERE o_orderstatus <> 'F'),
    other AS (SELECT book_ref, book_date, CAST(NULL AS DECIMAL(10, 2)) AS total_amount {_BOOKED_SQL} WHERE o_orderstatus = 'F')
    SELECT how, u.* FROM (SELECT * FROM first UNION ALL SELECT * FROM other) u, (SELECT unnest(['batch', 'stream']) AS how) h
    """,
)
def landing_by_name(t):
    """Two days whose files have other columns in another order, by batch and by stream."""
    landing, store = scratch_path(t.spark, "landing"), Store(t.spark, scratch_path(t.spark, "store"))
    bookings = staging(t, "bookings")["bookings"].drop("id", "created_at", "updated_at")
    finished = t.orders.where("o_orderstatus = 'F'").select(F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("book_ref"))
    _land(t, landing, "2024-01-15", bookings.join(finished, "book_ref", "left_anti").select("total_amount", "book_ref", "book_date"))
    _land(t, landing, "2024-01-16", bookings.join(finished, "book_ref", "left_semi").select("book_date", "book_ref"))
    table = TABLES["bookings"]
    batch = read_csv(t.spark, daily_root(landing, "bookings"), table.schema, table)
    stream = stream_daily_landings(store, table, landing, scratch_path(t.spark, "progress"), SECOND_RUN, rules=False)
    stream.awaitTermination()
    how = lambda df, name: _booked(df).select(F.lit(name).alias("how"), "*")
    return how(batch, "batch").unionByName(how(store.read("stg.bookings"), "stream"))


@query(
    "late_day",
    f"""
    WITH {STAGING_SQL}
    SELECT book_ref, book_date, CAST(CASE o_orderstatus WHEN 'F' THEN total_amount + 1 ELSE total_amount END AS DECIMAL(10, 2)) AS total_amount
    {_BOOKED_SQL}
    """,
)
def late_day(t):
    """The second day lands first; the first day then adds its rows and changes none that is newer."""
    landing, store, progress = (scratch_path(t.spark, n) for n in ("landing", "store", "progress"))
    store, bookings = Store(t.spark, store), staging(t, "bookings")["bookings"]
    for ds, rows in (("2024-01-16", _raised(t, bookings, 1, "F")), ("2024-01-15", bookings)):
        _land(t, landing, ds, rows)
        _stream(t, store, landing, progress)
    return _booked(store.read("stg.bookings"))


@query(
    "load_profile",
    f"""
    WITH {STAGING_SQL}
    SELECT 'bookings' AS "table", 'book_ref' AS "column", count(*) AS rows, count(*) - count(book_ref) AS nulls,
           min(book_ref) AS low, max(book_ref) AS high FROM bookings
    UNION ALL SELECT 'bookings', 'total_amount', count(*), count(*) - count(total_amount),
           min(total_amount)::VARCHAR, max(total_amount)::VARCHAR FROM bookings
    UNION ALL SELECT 'flights', 'flight_id', count(*), 0, min(flight_id)::VARCHAR, max(flight_id)::VARCHAR FROM flights
    UNION ALL SELECT 'flights', 'status', count(*), 0, min(status), max(status) FROM flights
    UNION ALL SELECT 'flights', 'actual_departure', count(*), count(*) - count(actual_departure), NULL, NULL FROM flights
    """,
)
def load_profiles(t):
    """What the one pass of an extract saw of its columns; times are left out for their format."""
    store, profiles = Store(t.spark, scratch_path(t.spark, "store")), []
    tables = ("bookings", "flights")
    extract_tables(staging(t, *tables).get, scratch_path(t.spark, "landing"), "2024-01-15", FIRST_RUN, tables=tables, profiles=profiles)
    record_profiles(store, profiles)
    shown = F.col("column").isin("book_ref", "total_amount", "flight_id", "status", "actual_departure")
    timeless = lambda c: F.when(F.col("column") != "actual_departure", F.col(c)).alias(c)
    return load_profile(store).where(shown).select("table", "column", "rows", "nulls", timeless("low"), timeless("high"))


@query(
    "load_waves",
    f"""
    WITH {STAGING_SQL},
    found AS (
        SELECT EXISTS (SELECT 1 FROM flights GROUP BY flight_no, scheduled_departure HAVING count(*) > 1)
               OR EXISTS (FROM flights WHERE aircraft_code NOT IN (SELECT p_brand FROM part)) AS flights_bad,
               EXISTS (SELECT 1 FROM boarding_passes GROUP BY flight_id, seat_no HAVING count(*) > 1)
               OR EXISTS (SELECT 1 FROM boarding_passes GROUP BY flight_id, boarding_no HAVING count(*) > 1) AS passes_bad),
    n AS (
        SELECT 'aircrafts_data' AS "table", count(*) AS rows FROM aircrafts_data
        UNION ALL SELECT 'airports_data', count(*) FROM airports_data UNION ALL SELECT 'bookings', count(*) FROM bookings
        UNION ALL SELECT 'flights', count(*) FROM flights UNION ALL SELECT 'seats', count(*) FROM seats
        UNION ALL SELECT 'tickets', count(*) FROM tickets UNION ALL SELECT 'ticket_flights', count(*) FROM ticket_flights
        UNION ALL SELECT 'boarding_passes', count(*) FROM boarding_passes),
    s AS (
        SELECT "table", rows, CASE
            WHEN "table" = 'flights' AND flights_bad THEN 'failed'
            WHEN "table" IN ('ticket_flights', 'boarding_passes') AND flights_bad THEN 'blocked'
            WHEN "table" = 'boarding_passes' AND passes_bad THEN 'failed' ELSE 'success' END AS status
        FROM n, found)
    SELECT "table", status, CASE status WHEN 'success' THEN rows WHEN 'blocked' THEN 0 END AS rows FROM s
    """,
)
def load_waves(t):
    """A full day with all rules on: tables that break one fail, those that refer to them wait, the rest is loaded."""
    store, tables = Store(t.spark, scratch_path(t.spark, "store")), tuple(TABLES)
    source, landing = staging(t, *tables), scratch_path(t.spark, "landing")  # the extract reads each of them once
    status = run_staging(store, source.get, landing, "2024-01-15", FIRST_RUN, on_failure="record")
    return status.where("step = 'load'").select("table", "status", "rows")


@query(
    "dump_roundtrip",
    f"""
    WITH {STAGING_SQL}
    SELECT 'tickets' AS "table", ticket_no AS key, book_ref || '|' || passenger_name || '|' || coalesce(phone, '') AS value FROM tickets
    UNION ALL SELECT 'ticket_flights', ticket_no || '|' || flight_id, fare_conditions || '|' || amount FROM ticket_flights
    """,
)
def dump_roundtrip(t):
    """Three tables written as one plain dump; two of them extracted from it by byte ranges."""
    root = scratch_path(t.spark, "dump")
    for name, df in staging(t, "tickets", "ticket_flights", "bookings").items():
        write_dump(df, name, f"{root}/{name}")
    source = dump_source(t.spark, root, split=1 << 18)
    phone = F.coalesce(F.get_json_object("contact_data", "$.phone"), F.lit(""))
    tickets = extract(source, "tickets").select(
        F.lit("tickets").alias("table"), F.col("ticket_no").alias("key"), F.concat_ws("|", "book_ref", "passenger_name", phone).alias("value")
    )
    segments = extract(source, "ticket_flights").select(
        F.lit("ticket_flights").alias("table"),
        F.concat_ws("|", "ticket_no", "flight_id").alias("key"),
        F.concat_ws("|", "fare_conditions", "amount").alias("value"),
    )
    return tickets.unionByName(segments)
