"""The eight staging tables: columns, keys, references and checks."""

import dataclasses

from pyspark.sql import types as T

from skyledger.functions.values import POINT

_STRING, _INT, _INSTANT = T.StringType(), T.IntegerType(), T.TimestampType()
_MONEY = T.DecimalType(10, 2)

# Fixed values of the source system.
FLIGHT_STATUSES = ("On Time", "Delayed", "Departed", "Arrived", "Scheduled", "Cancelled")
FARE_CONDITIONS = ("Economy", "Comfort", "Business")


def _one_of(column: str, values: tuple[str, ...]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


@dataclasses.dataclass(frozen=True)
class Reference:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclasses.dataclass(frozen=True)
class Table:
    name: str
    comment: str
    business: tuple[T.StructField, ...]
    key: tuple[str, ...]
    json: tuple[str, ...] = ()
    codes: tuple[str, ...] = ()  # fixed-width text, stored without trailing blanks
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[Reference, ...] = ()
    checks: tuple[tuple[str, str], ...] = ()  # name, SQL predicate that has to hold

    @property
    def schema(self) -> T.StructType:
        audit = [
            T.StructField("created_at", T.TimestampNTZType()),
            T.StructField("updated_at", T.TimestampNTZType()),
        ]
        return T.StructType([T.StructField("id", _STRING), *self.business, *audit])

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.business if not f.nullable)


def _col(name: str, data_type: T.DataType, comment: str, nullable: bool = False) -> T.StructField:
    return T.StructField(name, data_type, nullable, {"comment": comment})


AIRCRAFTS = Table(
    "aircrafts_data",
    "Aircraft models",
    (
        _col("aircraft_code", _STRING, "IATA code of the model"),
        _col("model", _STRING, "Model name per language, JSON"),
        _col("range", _INT, "Longest distance flown, km"),
    ),
    key=("aircraft_code",),
    json=("model",),
    codes=("aircraft_code",),
    checks=(("range_positive", "range > 0"),),
)

AIRPORTS = Table(
    "airports_data",
    "Airports",
    (
        _col("airport_code", _STRING, "IATA code of the airport"),
        _col("airport_name", _STRING, "Name per language, JSON"),
        _col("city", _STRING, "City per language, JSON"),
        _col("coordinates", POINT, "Longitude and latitude"),
        _col("timezone", _STRING, "Time zone name"),
    ),
    key=("airport_code",),
    json=("airport_name", "city"),
    codes=("airport_code",),
)

BOOKINGS = Table(
    "bookings",
    "Bookings",
    (
        _col("book_ref", _STRING, "Booking number"),
        _col("book_date", _INSTANT, "When it was booked"),
        _col("total_amount", _MONEY, "Cost of the whole booking"),
    ),
    key=("book_ref",),
    codes=("book_ref",),
)

FLIGHTS = Table(
    "flights",
    "Flights",
    (
        _col("flight_id", _INT, "Flight id"),
        _col("flight_no", _STRING, "Flight number"),
        _col("scheduled_departure", _INSTANT, "Planned departure"),
        _col("scheduled_arrival", _INSTANT, "Planned arrival"),
        _col("departure_airport", _STRING, "Code of the origin"),
        _col("arrival_airport", _STRING, "Code of the destination"),
        _col("status", _STRING, "Flight status"),
        _col("aircraft_code", _STRING, "Code of the aircraft model"),
        _col("actual_departure", _INSTANT, "Departure as flown", nullable=True),
        _col("actual_arrival", _INSTANT, "Arrival as flown", nullable=True),
    ),
    key=("flight_id",),
    codes=("flight_no", "departure_airport", "arrival_airport", "aircraft_code"),
    unique=(("flight_no", "scheduled_departure"),),
    references=(
        Reference(("aircraft_code",), "aircrafts_data", ("aircraft_code",)),
        Reference(("arrival_airport",), "airports_data", ("airport_code",)),
        Reference(("departure_airport",), "airports_data", ("airport_code",)),
    ),
    checks=(
        ("scheduled_order", "scheduled_arrival > scheduled_departure"),
        (
            "actual_order",
            "actual_arrival IS NULL OR (actual_departure IS NOT NULL AND actual_arrival > actual_departure)",
        ),
        ("status_known", _one_of("status", FLIGHT_STATUSES)),
    ),
)

SEATS = Table(
    "seats",
    "Seats of an aircraft model",
    (
        _col("aircraft_code", _STRING, "Code of the aircraft model"),
        _col("seat_no", _STRING, "Seat number"),
        _col("fare_conditions", _STRING, "Travel class"),
    ),
    key=("aircraft_code", "seat_no"),
    codes=("aircraft_code",),
    references=(Reference(("aircraft_code",), "aircrafts_data", ("aircraft_code",)),),
    checks=(("fare_known", _one_of("fare_conditions", FARE_CONDITIONS)),),
)

TICKETS = Table(
    "tickets",
    "Tickets",
    (
        _col("ticket_no", _STRING, "Ticket number"),
        _col("book_ref", _STRING, "Booking number"),
        _col("passenger_id", _STRING, "Passenger id"),
        _col("passenger_name", _STRING, "Passenger name"),
        _col("contact_data", _STRING, "Phone and e-mail, JSON", nullable=True),
    ),
    key=("ticket_no",),
    json=("contact_data",),
    codes=("ticket_no", "book_ref"),
    references=(Reference(("book_ref",), "bookings", ("book_ref",)),),
)

TICKET_FLIGHTS = Table(
    "ticket_flights",
    "Flight segments of a ticket",
    (
        _col("ticket_no", _STRING, "Ticket number"),
        _col("flight_id", _INT, "Flight id"),
        _col("fare_conditions", _STRING, "Travel class"),
        _col("amount", _MONEY, "Cost of the segment"),
    ),
    key=("ticket_no", "flight_id"),
    codes=("ticket_no",),
    references=(
        Reference(("flight_id",), "flights", ("flight_id",)),
        Reference(("ticket_no",), "tickets", ("ticket_no",)),
    ),
    checks=(
        ("amount_not_negative", "amount >= 0"),
        ("fare_known", _one_of("fare_conditions", FARE_CONDITIONS)),
    ),
)

BOARDING_PASSES = Table(
    "boarding_passes",
    "Boarding passes",
    (
        _col("ticket_no", _STRING, "Ticket number"),
        _col("flight_id", _INT, "Flight id"),
        _col("boarding_no", _INT, "Number of the pass on its flight"),
        _col("seat_no", _STRING, "Seat number"),
    ),
    key=("ticket_no", "flight_id"),
    codes=("ticket_no",),
    unique=(("flight_id", "boarding_no"), ("flight_id", "seat_no")),
    references=(Reference(("ticket_no", "flight_id"), "ticket_flights", ("ticket_no", "flight_id")),),
)

# Parents come before the tables that refer to them.
LOAD_ORDER = (AIRCRAFTS, AIRPORTS, BOOKINGS, FLIGHTS, SEATS, TICKETS, TICKET_FLIGHTS, BOARDING_PASSES)
TABLES = {table.name: table for table in LOAD_ORDER}
