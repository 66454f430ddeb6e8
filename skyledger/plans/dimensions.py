"""The four dimensions as queries over the staging tables."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.values import json_field
from skyledger.operators.joins import lookup
from skyledger.operators.snapshot import visible_versions

Frames = Mapping[str, DataFrame]


def dim_aircrafts(stg: Frames) -> DataFrame:
    return stg["aircrafts_data"].select(
        F.col("id").alias("aircraft_id"), F.col("aircraft_code").alias("aircraft_nk"), "model", "range"
    )


def dim_airport(stg: Frames) -> DataFrame:
    return stg["airports_data"].select(
        F.col("id").alias("airport_id"),
        F.col("airport_code").alias("airport_nk"),
        "airport_name",
        json_field(F.col("city"), "en").alias("city"),
        "coordinates",
        "timezone",
    )


def dim_passenger(stg: Frames) -> DataFrame:
    """One row per ticket, with the ticket's id as surrogate."""
    return stg["tickets"].select(
        F.col("id").alias("passenger_id"),
        F.col("passenger_id").alias("passenger_nk"),
        "passenger_name",
        json_field(F.col("contact_data"), "phone").alias("phone"),
        json_field(F.col("contact_data"), "email").alias("email"),
    )


def dim_seat(stg: Frames, dims: Frames, versions: str = "current") -> DataFrame:
    aircrafts = visible_versions(dims["dim_aircrafts"], versions)
    seats = stg["seats"].select(F.col("id").alias("seat_id"), "aircraft_code", "seat_no", "fare_conditions")
    return lookup(seats, aircrafts, "aircraft_nk", "aircraft_id", on="aircraft_code", name="aircraft_id").select(
        "seat_id", "aircraft_id", "seat_no", "fare_conditions"
    )
