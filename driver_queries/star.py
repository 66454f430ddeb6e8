"""Star joins in the shape of the facts, on the given tables as they are.

Orders stand for flights or tickets, lines for boarding passes or segments, parts for
aircraft, nations for airports in two roles, customers for passengers.
"""

from pyspark.sql import functions as F

from driver_queries.registry import query
from skyledger.operators import calendar, counts
from skyledger.operators.joins import lookup


@query(
    "occupancy_fact",
    """
    WITH taken AS (SELECT l_orderkey, count(l_returnflag) AS seat_occupied FROM lineitem GROUP BY 1),
         first_part AS (SELECT l_orderkey, min(p_brand) AS brand FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
         room AS (SELECT p_brand, count(p_partkey) AS total_seat FROM part GROUP BY 1)
    SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_flight, o_orderkey AS flight_nk, o_orderstatus AS status,
           brand AS aircraft_code, total_seat, seat_occupied, total_seat - seat_occupied AS empty_seats
    FROM orders JOIN taken ON taken.l_orderkey = o_orderkey
    JOIN first_part ON first_part.l_orderkey = o_orderkey
    JOIN room ON p_brand = brand
    WHERE o_orderstatus = 'F'
    """,
)
def occupancy_fact(t):
    """Lines are reduced to one row per order in one aggregate before any other join."""
    brands = t.part.select("p_partkey", "p_brand")
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_returnflag")
    per_order = (
        lines.join(brands, lines["l_partkey"] == brands["p_partkey"])
        .groupBy("l_orderkey")
        .agg(F.count("l_returnflag").alias("seat_occupied"), F.min("p_brand").alias("aircraft_code"))
    )
    room = counts.count_per_key(t.part, "p_brand", "p_partkey", "total_seat")
    orders = t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderdate", "o_orderstatus")
    dates = calendar.dim_date_over(t.orders, "o_orderdate")
    orders = calendar.add_roles(orders, {"flight": "o_orderdate"}, dates)
    out = orders.join(per_order, orders["o_orderkey"] == per_order["l_orderkey"])
    out = out.join(room, out["aircraft_code"] == room["p_brand"])
    return out.select(
        F.col("flight_date_local").alias("date_flight"),
        F.col("o_orderkey").alias("flight_nk"),
        F.col("o_orderstatus").alias("status"),
        "aircraft_code",
        "total_seat",
        "seat_occupied",
        (F.col("total_seat") - F.col("seat_occupied")).alias("empty_seats"),
    )


@query(
    "boarding_fact",
    """
    WITH passes AS (SELECT l_orderkey, l_partkey, min(l_linenumber) AS boarding_no FROM lineitem
                    WHERE l_linestatus = 'F' GROUP BY 1, 2)
    SELECT o_orderkey AS ticket_no, c_custkey AS passenger_id, p_partkey AS flight_id, boarding_no,
           l_quantity AS seat_no, p_brand AS aircraft_code
    FROM customer
    JOIN orders ON o_custkey = c_custkey
    JOIN lineitem l ON l.l_orderkey = o_orderkey
    JOIN part ON p_partkey = l.l_partkey
    JOIN passes ON passes.l_orderkey = l.l_orderkey AND passes.l_partkey = l.l_partkey
    """,
)
def boarding_fact(t):
    """Single-key, surrogate and composite joins; orders and lines share the hash on the order."""
    customers = t.customer.select(F.col("c_custkey").alias("passenger_id"))
    orders = t.orders.select(F.col("o_orderkey").alias("ticket_no"), F.col("o_custkey").alias("passenger_id"))
    line = {"ticket_no": F.col("l_orderkey"), "flight_id": F.col("l_partkey")}
    line = [column.alias(name) for name, column in line.items()]
    segments = t.lineitem.select(*line, F.col("l_quantity").alias("seat_no"))
    passes = (
        t.lineitem.where("l_linestatus = 'F'")
        .select(*line, "l_linenumber")
        .groupBy("ticket_no", "flight_id")
        .agg(F.min("l_linenumber").alias("boarding_no"))
    )
    flights = t.part.select(F.col("p_partkey").alias("flight_id"), F.col("p_brand").alias("aircraft_code"))
    return (
        orders.join(customers, "passenger_id")
        .join(segments, "ticket_no")
        .join(passes, ["ticket_no", "flight_id"])
        .join(flights, "flight_id")
        .select("ticket_no", "passenger_id", "flight_id", "boarding_no", "seat_no", "aircraft_code")
    )


@query(
    "booking_fact",
    """
    SELECT o_orderkey AS book_nk, c_custkey AS passenger_id, l_linenumber AS segment_no, l_partkey AS flight_nk,
           CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS book_date_local,
           CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS book_date_utc,
           0 AS book_time_utc,
           CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS scheduled_departure_date_utc,
           'N-' || dep.n_nationkey AS departure_airport, 'N-' || arr.n_nationkey AS arrival_airport,
           p_brand AS aircraft_code, l_extendedprice AS amount
    FROM orders
    JOIN customer ON c_custkey = o_custkey
    JOIN lineitem ON l_orderkey = o_orderkey
    JOIN part ON p_partkey = l_partkey
    JOIN supplier ON s_suppkey = l_suppkey
    JOIN nation dep ON dep.n_nationkey = s_nationkey
    JOIN nation arr ON arr.n_nationkey = c_nationkey
    """,
)
def booking_fact(t):
    """Each parent is looked up and dated on its own before it meets the lines."""
    airports = t.nation.select("n_nationkey", F.concat(F.lit("N-"), F.col("n_nationkey").cast("string")).alias("id"))
    dates = calendar.dim_date_over(t.orders, "o_orderdate").union(calendar.dim_date_over(t.lineitem, "l_shipdate"))
    dates = dates.distinct()
    times = calendar.dim_time(t.spark)

    bookings = calendar.add_roles(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), {"book": "o_orderdate"}, dates, times)
    passengers = lookup(t.customer.select("c_custkey", "c_nationkey"), airports, "n_nationkey", "id", "c_nationkey", "arrival_airport")
    origins = lookup(t.supplier.select("s_suppkey", "s_nationkey"), airports, "n_nationkey", "id", "s_nationkey", "departure_airport")
    aircraft = t.part.select("p_partkey", F.col("p_brand").alias("aircraft_code"))
    lines = calendar.add_roles(
        t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate"),
        {"scheduled_departure": "l_shipdate"},
        dates,
    )
    lines = lines.join(origins, lines["l_suppkey"] == origins["s_suppkey"])
    lines = lines.join(aircraft, lines["l_partkey"] == aircraft["p_partkey"])
    bookings = bookings.join(passengers, bookings["o_custkey"] == passengers["c_custkey"])
    return lines.join(bookings, lines["l_orderkey"] == bookings["o_orderkey"]).select(
        F.col("o_orderkey").alias("book_nk"),
        F.col("c_custkey").alias("passenger_id"),
        F.col("l_linenumber").alias("segment_no"),
        F.col("l_partkey").alias("flight_nk"),
        "book_date_local",
        "book_date_utc",
        "book_time_utc",
        "scheduled_departure_date_utc",
        "departure_airport",
        "arrival_airport",
        "aircraft_code",
        F.col("l_extendedprice").alias("amount"),
    )
