import datetime as dt
from decimal import Decimal

import pytest
from fleet import ROWS, at, frames
from pyspark.sql import functions as F

from skyledger.operators.quality import (
    RuleBroken,
    duplicate_keys,
    enforce,
    key_bitmaps,
    orphan_keys,
    table_violations,
    with_key_in,
)
from skyledger.schemas import TABLES


def with_extra(name, *rows):
    return {**ROWS, name: [*ROWS[name], *rows]}


def found(spark, name, rows=None):
    return {tuple(r) for r in table_violations(TABLES[name], frames(spark, rows)).drop("table").collect()}


@pytest.mark.parametrize("name", list(TABLES))
def test_clean_data_break_no_rule(spark, name):
    assert found(spark, name) == set()
    enforce(table_violations(TABLES[name], frames(spark)))


FLIGHT = dict(ROWS["flights"][0], flight_id=100, flight_no="PG0100")


@pytest.mark.parametrize(
    "name,row,want",
    [
        ("aircrafts_data", {"aircraft_code": "X", "model": "{}", "range": 0}, {("range_positive", "X", 1)}),
        ("aircrafts_data", {"aircraft_code": "X", "model": None, "range": None},
         {("not_null_model", "X", 1), ("not_null_range", "X", 1)}),
        ("flights", dict(FLIGHT, scheduled_arrival=FLIGHT["scheduled_departure"]), {("scheduled_order", "100", 1)}),
        ("flights", dict(FLIGHT, actual_departure=None), {("actual_order", "100", 1)}),
        ("flights", dict(FLIGHT, actual_arrival=at("2024-01-01 00:00:00")), {("actual_order", "100", 1)}),
        ("flights", dict(FLIGHT, actual_arrival=None), set()),
        ("flights", dict(FLIGHT, status="Lost"), {("status_known", "100", 1)}),
        ("flights", dict(FLIGHT, aircraft_code="???"), {("aircraft_code_in_aircrafts_data", "???", 1)}),
        ("flights", dict(FLIGHT, arrival_airport="???"), {("arrival_airport_in_airports_data", "???", 1)}),
        ("flights", dict(FLIGHT, departure_airport="???"), {("departure_airport_in_airports_data", "???", 1)}),
        ("flights", dict(FLIGHT, flight_no="PG0001"),
         {("unique_flight_no_scheduled_departure", "PG0001|2024-01-15 22:00:00", 2)}),
        ("flights", dict(FLIGHT, flight_id=1), {("unique_flight_id", "1", 2)}),
        ("seats", {"aircraft_code": "773", "seat_no": "9A", "fare_conditions": "Roof"}, {("fare_known", "773|9A", 1)}),
        ("seats", {"aircraft_code": "773", "seat_no": "1A", "fare_conditions": "Economy"},
         {("unique_aircraft_code_seat_no", "773|1A", 2)}),
        ("tickets", {"ticket_no": "1", "book_ref": "none", "passenger_id": "p", "passenger_name": "n"},
         {("book_ref_in_bookings", "none", 1)}),
        ("ticket_flights", {"ticket_no": "0005432000990", "flight_id": 2, "fare_conditions": "Economy", "amount": Decimal("-1")},
         {("amount_not_negative", "0005432000990|2", 1)}),
        ("ticket_flights", {"ticket_no": "no", "flight_id": 77, "fare_conditions": "Economy", "amount": Decimal("1")},
         {("flight_id_in_flights", "77", 1), ("ticket_no_in_tickets", "no", 1)}),
        ("boarding_passes", {"ticket_no": "0005432000990", "flight_id": 1, "boarding_no": 2, "seat_no": "3A"},
         {("unique_flight_id_boarding_no", "1|2", 2), ("unique_flight_id_seat_no", "1|3A", 2)}),
        ("boarding_passes", {"ticket_no": "0005432000990", "flight_id": 3, "boarding_no": 9, "seat_no": "9A"},
         {("ticket_no_flight_id_in_ticket_flights", "0005432000990|3", 1)}),
    ],
)
def test_each_rule(spark, name, row, want):
    rows = with_extra(name, row)
    assert found(spark, name, rows) == want
    if want:
        with pytest.raises(RuleBroken, match=sorted(want)[0][0]):
            enforce(table_violations(TABLES[name], frames(spark, rows)))


def test_nulls_neither_clash_nor_refer(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 1), (2, 1), (3, None)], "a int, b int")
    assert [tuple(r) for r in duplicate_keys(df, ["a", "b"]).collect()] == [(2, 1, 2)]
    parent = spark.createDataFrame([(9,)], "a int")
    assert sorted(map(tuple, orphan_keys(df, parent, ["a"]).collect())) == [(2, 2), (3, 1)]


def test_bitmaps_divide_rows(spark):
    """Every row is on one side; those with a key of the bitmaps are all on theirs, few others with them."""
    keys = spark.range(0, 4000, 4).select("id", (F.col("id") % 3).cast("string").alias("s"))
    rows = spark.range(4000).select("id", (F.col("id") % 3).cast("string").alias("s")).union(spark.sql("SELECT NULL, NULL"))
    for bits, most in ((1 << 24, 1010), (64, 4001)):
        maps = key_bitmaps(keys, ["id", "s"], bits)
        inside, outside = with_key_in(rows, ["id", "s"], maps, bits), with_key_in(rows, ["id", "s"], maps, bits, invert=True)
        assert inside.count() + outside.count() == 4001 and 1000 <= inside.count() <= most
        assert outside.where("id % 4 = 0").isEmpty() and inside.where("id % 4 = 0").count() == 1000
    none = key_bitmaps(keys.where("false"), ["id", "s"])
    assert with_key_in(rows, ["id", "s"], none).isEmpty() and with_key_in(rows, ["id", "s"], none, invert=True).count() == 4001


def test_checks_shuffle_counts_not_rows(spark, tmp_path):
    """Duplicates and orphans are counted per task before any exchange."""
    spark.range(1000).selectExpr("id % 7 AS k", "uuid() AS wide").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    for found in (duplicate_keys(df, ["k"]), orphan_keys(df, df.where("k > 3"), ["k"])):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "partial_count" in plan and "wide" not in plan


def test_stamp_type():
    assert isinstance(ROWS["flights"][0]["scheduled_departure"], dt.datetime)
