"""The four facts as queries over staging tables and dimensions.

Flights and bookings are far fewer than tickets, segments and boarding passes. So every
calendar, airport and aircraft lookup runs on the flight or booking itself, before it
meets the large tables; these then take part in key joins only. All joins are inner, so
the order does not change the result.
"""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions import clock
from skyledger.operators.calendar import add_roles
from skyledger.operators.counts import count_per_key
from skyledger.operators.joins import as_of_lookup, lookup
from skyledger.operators.snapshot import VALID_FROM, VALID_TO, visible_versions

Frames = Mapping[str, DataFrame]

PLANNED = ("scheduled_departure", "scheduled_arrival")
FLOWN = ("actual_departure", "actual_arrival")


def _role_columns(*roles: str) -> list[str]:
    return [f"{role}_{part}" for role in roles for part in ("date_local", "date_utc", "time_local", "time_utc")]


def _with_places(flights: DataFrame, dims: Frames, versions: str) -> DataFrame:
    """Replace airport and aircraft codes by the surrogate ids of the dimensions.

    With `versions="as_of"` they are those of the version that was valid when the flight left, the first
    version being valid from the beginning.
    """
    if versions == "as_of":
        left_at = F.coalesce("actual_departure", "scheduled_departure").cast("timestamp_ntz")
        out = flights.withColumn("_left_at", left_at)
        for dim, natural, surrogate, on in (
            ("dim_airport", "airport_nk", "airport_id", "departure_airport"),
            ("dim_airport", "airport_nk", "airport_id", "arrival_airport"),
            ("dim_aircrafts", "aircraft_nk", "aircraft_id", "aircraft_code"),
        ):
            out = as_of_lookup(out, dims[dim], natural, on, "_left_at", {surrogate: "_id"}, VALID_FROM, VALID_TO, backdate=True)
            out = out.withColumn(on, F.col("_id")).drop("_id")
        return out.drop("_left_at")
    airports = visible_versions(dims["dim_airport"], versions)
    aircrafts = visible_versions(dims["dim_aircrafts"], versions)
    out = lookup(flights, airports, "airport_nk", "airport_id", on="departure_airport", name="_departure_id")
    out = lookup(out, airports, "airport_nk", "airport_id", on="arrival_airport", name="_arrival_id")
    out = lookup(out, aircrafts, "aircraft_nk", "aircraft_id", on="aircraft_code", name="_aircraft_id")
    replaced = {
        "departure_airport": F.col("_departure_id"),
        "arrival_airport": F.col("_arrival_id"),
        "aircraft_code": F.col("_aircraft_id"),
    }
    return out.withColumns(replaced).drop("_departure_id", "_arrival_id", "_aircraft_id")


def _flights_in_roles(
    stg: Frames, dims: Frames, roles: tuple[str, ...], zone: str, versions: str, truncate: bool, *extra
) -> DataFrame:
    flights = stg["flights"].select(
        "flight_id", "flight_no", *PLANNED, "departure_airport", "arrival_airport", "status", "aircraft_code", *FLOWN
    )
    flights = add_roles(
        flights, {r: r for r in roles}, dims["dim_date"], dims["dim_time"], zone=zone, truncate=truncate
    )
    return _with_places(flights, dims, versions).select(
        "flight_id",
        "flight_no",
        *_role_columns(*roles),
        "departure_airport",
        "arrival_airport",
        "aircraft_code",
        "status",
        *extra,
    )


def fct_seat_occupied_daily(stg: Frames, dims: Frames, zone: str = clock.UTC, versions: str = "current") -> DataFrame:
    """Seats taken and left on each arrived flight, by the day it left.

    Passes are counted per flight before they meet the flight, so a full flight sends one
    row per task instead of all its passes. Only arrived flights have a count, hence the
    status filter on the flight; flight_id is the key of flights, so no second copy of
    the flights is joined to get it.
    """
    occupied = count_per_key(stg["boarding_passes"], "flight_id", "seat_no", "seat_occupied")
    capacity = count_per_key(stg["seats"], "aircraft_code", "seat_no", "total_seat")
    flights = stg["flights"].where(F.col("status") == "Arrived").select(
        "flight_id",
        "flight_no",
        "departure_airport",
        "arrival_airport",
        "aircraft_code",
        "status",
        "actual_departure",
    )
    flights = add_roles(flights, {"flight": "actual_departure"}, dims["dim_date"], zone=zone)
    flights = flights.join(capacity, "aircraft_code", "inner")
    flights = _with_places(flights, dims, versions)
    return flights.join(occupied, "flight_id", "inner").select(
        F.col("flight_date_local").alias("date_flight"),
        F.col("flight_id").alias("flight_nk"),
        "flight_no",
        "departure_airport",
        "arrival_airport",
        "aircraft_code",
        "status",
        "total_seat",
        "seat_occupied",
        (F.col("total_seat") - F.col("seat_occupied")).alias("empty_seats"),
    )


def fct_flight_activity(
    stg: Frames, dims: Frames, zone: str = clock.UTC, versions: str = "current", truncate: bool = False
) -> DataFrame:
    """Planned and flown times of each flown flight, with its delays."""
    delays = (
        clock.elapsed(F.col("scheduled_departure"), F.col("actual_departure")).alias("delay_departure"),
        clock.elapsed(F.col("scheduled_arrival"), F.col("actual_arrival")).alias("delay_arrival"),
        clock.elapsed(F.col("actual_departure"), F.col("actual_arrival")).alias("travel_time"),
    )
    flights = _flights_in_roles(stg, dims, (*PLANNED, *FLOWN), zone, versions, truncate, *delays)
    return flights.select(
        F.col("flight_id").alias("flight_nk"),
        "flight_no",
        *_role_columns(*PLANNED),
        "departure_airport",
        "arrival_airport",
        "aircraft_code",
        *_role_columns(*FLOWN),
        "status",
        "delay_departure",
        "delay_arrival",
        "travel_time",
    )


def fct_boarding_pass(
    stg: Frames, dims: Frames, zone: str = clock.UTC, versions: str = "current", truncate: bool = False
) -> DataFrame:
    """Each boarding pass with its ticket, passenger and planned flight.

    Tickets, segments and passes are hashed by ticket_no once; the (ticket_no, flight_id)
    join reuses that. Only then do the flights come in.
    """
    passengers = visible_versions(dims["dim_passenger"], versions).select("passenger_id")
    tickets = stg["tickets"].select("ticket_no", "book_ref", F.col("id").alias("passenger_id"))
    segments = stg["ticket_flights"].select("ticket_no", "flight_id", "fare_conditions")
    passes = stg["boarding_passes"].select("ticket_no", "flight_id", "boarding_no", "seat_no")
    flights = _flights_in_roles(stg, dims, PLANNED, zone, versions, truncate)
    return (
        tickets.join(passengers, "passenger_id", "inner")
        .join(segments, "ticket_no", "inner")
        .join(passes, ["ticket_no", "flight_id"], "inner")
        .join(flights, "flight_id", "inner")
        .select(
            "ticket_no",
            "book_ref",
            "passenger_id",
            "flight_id",
            "flight_no",
            "boarding_no",
            *_role_columns(*PLANNED),
            "departure_airport",
            "arrival_airport",
            "aircraft_code",
            "status",
            "fare_conditions",
            "seat_no",
        )
    )


def fct_booking_ticket(
    stg: Frames,
    dims: Frames,
    zone: str = clock.UTC,
    versions: str = "current",
    truncate: bool = False,
    passenger_join: str = "surrogate",
) -> DataFrame:
    """Each segment of a booked ticket on a flown flight.

    `passenger_join="surrogate"` matches the ticket's own row of the passengers. `"natural"`
    matches by passenger number; the dimension has a row per ticket, so a passenger with
    several tickets then repeats the segments of each.
    """
    bookings = stg["bookings"].select("book_ref", "book_date", "total_amount")
    bookings = add_roles(
        bookings, {"book": "book_date"}, dims["dim_date"], dims["dim_time"], zone=zone, truncate=truncate
    )
    passengers = visible_versions(dims["dim_passenger"], versions)
    tickets = stg["tickets"].select("ticket_no", "book_ref", F.col("passenger_id").alias("passenger_nk"), "id")
    if passenger_join == "natural":
        tickets = tickets.join(passengers.select("passenger_id", "passenger_nk"), "passenger_nk", "inner")
    elif passenger_join == "surrogate":
        tickets = tickets.withColumnRenamed("id", "passenger_id").join(
            passengers.select("passenger_id"), "passenger_id", "inner"
        )
    else:
        raise ValueError(f"passenger_join is 'natural' or 'surrogate', not {passenger_join!r}")
    segments = stg["ticket_flights"].select("ticket_no", "flight_id", "fare_conditions", "amount")
    flights = _flights_in_roles(stg, dims, (*PLANNED, *FLOWN), zone, versions, truncate)
    return (
        tickets.join(bookings, "book_ref", "inner")
        .join(segments, "ticket_no", "inner")
        .join(flights, "flight_id", "inner")
        .select(
            F.col("book_ref").alias("book_nk"),
            *_role_columns("book"),
            "total_amount",
            "ticket_no",
            "passenger_id",
            F.col("flight_id").alias("flight_nk"),
            "fare_conditions",
            "amount",
            "flight_no",
            *_role_columns(*PLANNED),
            "departure_airport",
            "arrival_airport",
            "status",
            "aircraft_code",
            *_role_columns(*FLOWN),
        )
    )
