"""The eight staging tables, derived from the given tables by Spark and by SQL.

events become flights, orders become bookings and tickets, lines become segments and
boarding passes, brands become aircraft and nations airports. Both derivations read
the whole tables.
"""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.values import json_field, stable_id
from skyledger.schemas import TABLES
from skyledger.session import scratch_path


def _code(column: str, width: int):
    return F.lpad(F.col(column).cast("string"), width, "0")


def _english(text):
    return F.concat(F.lit('{"en":"'), text, F.lit('"}'))


def _finish(name: str, df: DataFrame) -> DataFrame:
    """Columns and types of the staging schema, with the surrogate id."""
    table = TABLES[name]
    stamps = {c: F.lit("2024-01-14 12:00:00").cast("timestamp_ntz") for c in ("created_at", "updated_at")}
    df = df.withColumn("id", stable_id(name, *[F.col(k) for k in table.key])).withColumns(stamps)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields])


def _aircrafts(t):
    brands = t.part.groupBy("p_brand").agg(F.max("p_size").alias("size"))
    return brands.select(
        F.col("p_brand").alias("aircraft_code"),
        _english(F.col("p_brand")).alias("model"),
        (1000 + 100 * F.col("size")).alias("range"),
    )


def _airports(t):
    x, y = F.col("n_nationkey").cast("double"), F.col("n_regionkey").cast("double")
    return t.nation.select(
        _code("n_nationkey", 3).alias("airport_code"),
        _english(F.col("n_name")).alias("airport_name"),
        F.concat(F.lit('{"en":"City of '), F.col("n_name"), F.lit('","ru":null}')).alias("city"),
        F.struct(x.alias("x"), y.alias("y")).alias("coordinates"),
        F.concat(F.lit("Region/"), F.col("n_regionkey").cast("string")).alias("timezone"),
    )


def _bookings(t):
    second = F.pmod(F.col("o_orderkey"), F.lit(86_400))
    booked = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + second)
    return t.orders.select(
        _code("o_orderkey", 10).alias("book_ref"),
        booked.alias("book_date"),
        F.col("o_totalprice").alias("total_amount"),
    )


def _flights(t):
    k = F.col("k")
    minutes = lambda n: F.make_dt_interval(mins=n)
    planned = F.date_trunc("second", F.col("ts").cast("timestamp"))
    # A few arrivals keep half a second, so that they find no time of day.
    fraction = F.when(F.col("value") < 1, F.expr("INTERVAL '0.5' SECOND")).otherwise(F.expr("INTERVAL '0' SECOND"))
    left = F.when(F.col("event_type").isin("purchase", "view", "click"), planned + minutes(k - 20))
    status = (
        F.when(F.col("event_type").isin("purchase", "click"), "Arrived")
        .when(F.col("event_type") == "view", "Departed")
        .when(F.col("event_type") == "error", "Cancelled")
        .otherwise("Scheduled")
    )
    return t.events.withColumn("k", json_field(F.col("props"), "k").cast("int")).select(
        F.col("event_id").alias("flight_id"),
        F.concat(F.lit("F"), _code("user_id", 5)).alias("flight_no"),
        planned.alias("scheduled_departure"),
        (planned + minutes(60 + 7 * k) + fraction).alias("scheduled_arrival"),
        F.lpad(F.pmod("user_id", F.lit(25)).cast("string"), 3, "0").alias("departure_airport"),
        F.lpad(F.pmod(k, F.lit(25)).cast("string"), 3, "0").alias("arrival_airport"),
        status.alias("status"),
        F.concat(F.lit("Brand#"), (1 + F.pmod("event_id", F.lit(25))).cast("string")).alias("aircraft_code"),
        left.alias("actual_departure"),
        (left + minutes(50 + k)).alias("actual_arrival"),
    )


def _seats(t):
    fare = F.when(F.col("p_size") < 5, "Business").when(F.col("p_size") < 15, "Comfort").otherwise("Economy")
    return t.part.select(
        F.col("p_brand").alias("aircraft_code"), F.col("p_partkey").alias("seat_no"), fare.alias("fare_conditions")
    )


def _tickets(t):
    contact = F.concat(
        F.lit('{"phone":"+'), F.col("c_custkey").cast("string"),
        F.lit('","email":"'), F.lower("c_mktsegment"), F.lit('@example.org"}'),
    )
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        _code("o_orderkey", 13).alias("ticket_no"),
        _code("o_orderkey", 10).alias("book_ref"),
        F.concat_ws("-", F.col("c_custkey").cast("string"), F.col("o_orderkey").cast("string")).alias("passenger_id"),
        F.col("c_name").alias("passenger_name"),
        F.when(F.col("o_orderpriority") != "5-LOW", contact).alias("contact_data"),
    )


def _segments(t):
    fare = (
        F.when(F.max("l_returnflag") == "A", "Business").when(F.max("l_returnflag") == "N", "Comfort").otherwise("Economy")
    )
    grouped = t.lineitem.groupBy(_code("l_orderkey", 13).alias("ticket_no"), F.col("l_partkey").alias("flight_id"))
    return grouped.agg(fare.alias("fare_conditions"), F.max("l_extendedprice").alias("amount"))


def _passes(t):
    lines = t.lineitem.where("l_linestatus = 'F'")
    grouped = lines.groupBy(_code("l_orderkey", 13).alias("ticket_no"), F.col("l_partkey").alias("flight_id"))
    return grouped.agg(F.min("l_linenumber").alias("boarding_no"), F.min("l_suppkey").alias("seat_no"))


_BUILDERS = {
    "aircrafts_data": _aircrafts,
    "airports_data": _airports,
    "bookings": _bookings,
    "flights": _flights,
    "seats": _seats,
    "tickets": _tickets,
    "ticket_flights": _segments,
    "boarding_passes": _passes,
}


def staging(t, *names: str) -> dict[str, DataFrame]:
    """The named staging tables, or all of them, as queries."""
    return {name: _finish(name, _BUILDERS[name](t)) for name in names or _BUILDERS}


def stored(t, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The frames written to the shared folder and read back, as a warehouse has them."""
    root = scratch_path(t.spark, "derived")

    def write(name: str) -> DataFrame:
        frames[name].write.parquet(f"{root}/{name}")
        return t.spark.read.parquet(f"{root}/{name}")

    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        return dict(zip(frames, pool.map(write, frames)))


def _id(table: str, key: str) -> str:
    digest = f"md5('{table}|' || {key})"
    return " || '-' || ".join(f"{digest}[{a}:{b}]" for a, b in ((1, 8), (9, 12), (13, 16), (17, 20), (21, 32)))


STAGING_SQL = f"""
    aircrafts_data AS (
        SELECT {_id('aircrafts_data', 'p_brand')} AS id, p_brand AS aircraft_code,
               '{{"en":"' || p_brand || '"}}' AS model, CAST(1000 + 100 * max(p_size) AS INTEGER) AS range
        FROM part GROUP BY p_brand),
    airports_data AS (
        SELECT {_id('airports_data', "lpad(n_nationkey::VARCHAR, 3, '0')")} AS id,
               lpad(n_nationkey::VARCHAR, 3, '0') AS airport_code,
               '{{"en":"' || n_name || '"}}' AS airport_name, '{{"en":"City of ' || n_name || '","ru":null}}' AS city,
               n_nationkey AS x, n_regionkey AS y, 'Region/' || n_regionkey AS timezone
        FROM nation),
    bookings AS (
        SELECT lpad(o_orderkey::VARCHAR, 10, '0') AS book_ref, o_orderdate + to_seconds(o_orderkey % 86400) AS book_date,
               CAST(o_totalprice AS DECIMAL(10, 2)) AS total_amount
        FROM orders),
    numbered AS (SELECT *, CAST(props->>'k' AS INTEGER) AS k, date_trunc('second', ts) AS planned FROM events),
    flown AS (
        SELECT *, CASE WHEN event_type IN ('purchase', 'view', 'click') THEN planned + to_minutes(k - 20) END AS departed
        FROM numbered),
    flights AS (
        SELECT CAST(event_id AS INTEGER) AS flight_id, 'F' || lpad(user_id::VARCHAR, 5, '0') AS flight_no,
               planned AS scheduled_departure,
               planned + to_minutes(60 + 7 * k) + CASE WHEN value < 1 THEN INTERVAL 500 MILLISECOND ELSE INTERVAL 0 SECOND END
                   AS scheduled_arrival,
               lpad((user_id % 25)::VARCHAR, 3, '0') AS departure_airport, lpad((k % 25)::VARCHAR, 3, '0') AS arrival_airport,
               CASE event_type WHEN 'purchase' THEN 'Arrived' WHEN 'click' THEN 'Arrived' WHEN 'view' THEN 'Departed'
                    WHEN 'error' THEN 'Cancelled' ELSE 'Scheduled' END AS status,
               'Brand#' || (1 + event_id % 25) AS aircraft_code, departed AS actual_departure,
               departed + to_minutes(50 + k) AS actual_arrival
        FROM flown),
    seats AS (
        SELECT {_id('seats', "p_brand || '|' || p_partkey")} AS id, p_brand AS aircraft_code, p_partkey::VARCHAR AS seat_no,
               CASE WHEN p_size < 5 THEN 'Business' WHEN p_size < 15 THEN 'Comfort' ELSE 'Economy' END AS fare_conditions
        FROM part),
    tickets AS (
        SELECT {_id('tickets', "lpad(o_orderkey::VARCHAR, 13, '0')")} AS id, lpad(o_orderkey::VARCHAR, 13, '0') AS ticket_no,
               lpad(o_orderkey::VARCHAR, 10, '0') AS book_ref, c_custkey || '-' || o_orderkey AS passenger_id,
               c_name AS passenger_name,
               CASE WHEN o_orderpriority <> '5-LOW' THEN '+' || c_custkey END AS phone,
               CASE WHEN o_orderpriority <> '5-LOW' THEN lower(c_mktsegment) || '@example.org' END AS email
        FROM orders JOIN customer ON c_custkey = o_custkey),
    ticket_flights AS (
        SELECT lpad(l_orderkey::VARCHAR, 13, '0') AS ticket_no, CAST(l_partkey AS INTEGER) AS flight_id,
               CASE max(l_returnflag) WHEN 'A' THEN 'Business' WHEN 'N' THEN 'Comfort' ELSE 'Economy' END AS fare_conditions,
               CAST(max(l_extendedprice) AS DECIMAL(10, 2)) AS amount
        FROM lineitem GROUP BY 1, 2),
    boarding_passes AS (
        SELECT lpad(l_orderkey::VARCHAR, 13, '0') AS ticket_no, CAST(l_partkey AS INTEGER) AS flight_id,
               min(l_linenumber) AS boarding_no, min(l_suppkey)::VARCHAR AS seat_no
        FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2)
"""
