"""Sources, sinks, projections, expressions, calendars and counts."""

import functools
import uuid
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driver_queries.registry import query
from skyledger.functions import clock
from skyledger.functions.values import json_field, stable_id
from skyledger.operators import calendar, counts
from skyledger.operators.joins import lookup
from skyledger.sources import landing, sqltext
from skyledger.sources.extract import extract, parquet_source, plan_splits, touched_on
from skyledger.schemas import TABLES
from skyledger.session import scratch_path

JAKARTA = "Asia/Jakarta"


@query("extract_full", "SELECT * FROM customer")
def extract_full(t):
    return extract(parquet_source(t.spark, t.folder, ".parquet"), "customer")


@query("extract_splits", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def extract_splits(t):
    """Customers in eight ranges of their name, planned from those that an earlier extract had."""
    last = t.customer.where("c_acctbal > 0")
    ranges = plan_splits(last, "c_name", 8, collation="UTF8_BINARY")
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    return functools.reduce(DataFrame.union, [rows.where(one) for one in ranges])


@query(
    "extract_incremental",
    """
    WITH stamped AS (
        SELECT event_id, event_type, ts AS created_at,
               ts + CASE WHEN event_type = 'click' THEN INTERVAL 2 DAY ELSE INTERVAL 0 DAY END AS updated_at
        FROM events)
    SELECT * FROM stamped
    WHERE created_at::DATE = DATE '2024-01-15' OR updated_at::DATE = DATE '2024-01-15'
    """,
)
def extract_incremental(t):
    later = F.when(F.col("event_type") == "click", F.expr("INTERVAL 2 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    stamped = t.events.select(
        "event_id", "event_type", F.col("ts").alias("created_at"), (F.col("ts") + later).alias("updated_at")
    )
    return touched_on(stamped, clock.data_day("2024-01-16"))


@query("csv_roundtrip", "SELECT * FROM supplier")
def csv_roundtrip(t):
    path = landing.landing_path(scratch_path(t.spark, "csv"), "supplier", incremental=True, ds="2024-01-16")
    landing.write_csv(t.supplier, path)
    return landing.read_csv(t.spark, path, t.supplier.schema)


@query("csv_roundtrip_missing", "SELECT event_id, ts, nullif(event_type, 'error') AS event_type, props FROM events")
def csv_roundtrip_missing(t):
    path = scratch_path(t.spark, "csv")
    rows = t.events.select("event_id", "ts", F.nullif("event_type", F.lit("error")).alias("event_type"), "props")
    landing.write_csv(rows, path)
    return landing.read_csv(t.spark, path, rows.schema)


@query("json_roundtrip", "SELECT * FROM customer")
def json_roundtrip(t):
    path = scratch_path(t.spark, "json")
    landing.write_json(t.customer, path)
    return landing.read_json(t.spark, path, t.customer.schema)


SQL_FILES = Path(__file__).parent / "sql"


@query("sql_file_frame", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def sql_file_frame(t):
    t.orders.createOrReplaceTempView("orders_in")
    return sqltext.sql_file_frame(t.spark, str(SQL_FILES / "finished_orders.sql"), {"status": "F"})


@query("sql_file_execute", "SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY 1")
def sql_file_execute(t):
    t.customer.createOrReplaceTempView("customer_in")
    sqltext.run_sql_file(t.spark, str(SQL_FILES / "segment_sizes.sql"))
    return t.spark.table("segment_sizes")


@query(
    "transform_by_name",
    "SELECT n_name, count(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1",
)
def transform_by_name(t):
    t.supplier.createOrReplaceTempView("supplier_in")
    t.nation.createOrReplaceTempView("nation_in")
    return sqltext.transform_by_name(t.spark, str(SQL_FILES), "nation_suppliers")


@query("append_rows", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def append_rows(t):
    table = f"appended_{uuid.uuid4().hex}"
    location = scratch_path(t.spark, table)
    t.spark.sql(
        f"CREATE TABLE {table} (o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE) "
        f"USING parquet LOCATION '{location}'"
    )
    finished = F.col("o_orderstatus") == "F"
    sqltext.append_rows(t.orders.where(finished), table)
    sqltext.insert_frame(t.spark, str(SQL_FILES / "insert_orders.sql"), t.orders.where(~finished), {"target": table})
    rows = t.spark.read.parquet(location)
    t.spark.sql(f"DROP TABLE {table}")  # the files stay, as their place was given
    return rows


@query(
    "dim_rename",
    "SELECT p_partkey AS aircraft_id, p_brand AS aircraft_nk, p_name AS model, p_size AS range FROM part",
)
def dim_rename(t):
    return t.part.select(
        F.col("p_partkey").alias("aircraft_id"),
        F.col("p_brand").alias("aircraft_nk"),
        F.col("p_name").alias("model"),
        F.col("p_size").alias("range"),
    )


@query("json_text", "SELECT event_id, props->>'k' AS k, props->>'absent' AS absent FROM events")
def json_text(t):
    props = F.col("props")
    return t.events.select("event_id", json_field(props, "k").alias("k"), json_field(props, "absent").alias("absent"))


@query(
    "json_documents",
    """
    SELECT c_custkey AS ticket_no,
           CASE WHEN c_custkey % 5 > 1 THEN '{"phone":"+' || c_nationkey || '","segment":"' || c_mktsegment || '"}' END AS contact_data
    FROM customer
    """,
)
def json_documents(t):
    """Nested values as JSON with sorted keys; missing and empty documents of a nullable column are NULL."""
    filled = F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("phone"), F.concat(F.lit("+"), F.col("c_nationkey").cast("string")))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    kind = F.col("c_custkey") % 5
    document = F.when(kind > 1, filled).when(kind == 1, empty).alias("contact_data")
    return landing.to_landing(t.customer.select(F.col("c_custkey").alias("ticket_no"), document), TABLES["tickets"])


@query(
    "dim_lookup",
    """
    SELECT s_suppkey, s_name, md5('nation|' || n_nationkey) AS nation_id
    FROM supplier JOIN nation ON n_nationkey = s_nationkey
    """,
)
def dim_lookup(t):
    dim = t.nation.select("n_nationkey", F.md5(F.concat(F.lit("nation|"), F.col("n_nationkey").cast("string"))).alias("id"))
    return lookup(t.supplier, dim, "n_nationkey", "id", on="s_nationkey", name="nation_id").select(
        "s_suppkey", "s_name", "nation_id"
    )


@query(
    "surrogate_ids",
    """
    WITH d AS (SELECT c_custkey, md5('customer|' || c_custkey) AS h FROM customer)
    SELECT c_custkey, h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] AS id FROM d
    """,
)
def surrogate_ids(t):
    return t.customer.select("c_custkey", stable_id("customer", F.col("c_custkey")).alias("id"))


@query(
    "dim_date",
    """
    WITH span AS (SELECT min(o_orderdate)::DATE - 1 AS low, max(o_orderdate)::DATE + 1 AS high FROM orders),
         days AS (SELECT unnest(generate_series(low, high, INTERVAL 1 DAY))::DATE AS date_actual FROM span)
    SELECT CAST(strftime(date_actual, '%Y%m%d') AS INTEGER) AS date_id, date_actual FROM days
    """,
)
def dim_date(t):
    return calendar.dim_date_over(t.orders, "o_orderdate")


@query(
    "dim_time",
    """
    WITH clock AS (SELECT CAST(i AS INTEGER) AS time_id, strftime(TIMESTAMP '1970-01-01' + to_seconds(i), '%H:%M:%S') AS time_actual
                   FROM range(86400) r(i)),
         seen AS (SELECT strftime(ts, '%H:%M:%S') AS time_actual, count(*) AS events FROM events GROUP BY 1)
    SELECT time_id, time_actual, events FROM clock JOIN seen USING (time_actual)
    """,
)
def dim_time(t):
    """Events per second of the day, by way of the time dimension."""
    seen = t.events.groupBy(F.date_format("ts", "HH:mm:ss").alias("time_actual")).agg(F.count("*").alias("events"))
    return calendar.dim_time(t.spark).join(seen, "time_actual").select("time_id", "time_actual", "events")


@query(
    "role_dates",
    """
    WITH span AS (SELECT least(min(o_orderdate), min(l_shipdate))::DATE AS low,
                         greatest(max(o_orderdate), max(l_shipdate))::DATE AS high
                  FROM orders, (SELECT min(l_shipdate) AS l_shipdate FROM lineitem UNION ALL SELECT max(l_shipdate) FROM lineitem)),
         days AS (SELECT unnest(generate_series(low, high, INTERVAL 1 DAY))::DATE AS day FROM span),
         cal AS (SELECT day, year(day) * 10000 + month(day) * 100 + day(day) AS date_id FROM days)
    SELECT l_orderkey, l_linenumber, l_partkey,
           CAST(a.date_id AS INTEGER) AS order_date_local, CAST(b.date_id AS INTEGER) AS ship_date_local
    FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey
    JOIN cal a ON a.day = o_orderdate::DATE
    JOIN cal b ON b.day = l_shipdate::DATE
    """,
)
def role_dates(t):
    dates = calendar.dim_date_over(t.orders, "o_orderdate").union(calendar.dim_date_over(t.lineitem, "l_shipdate"))
    orders = calendar.add_roles(
        t.orders.select("o_orderkey", "o_orderdate"), {"order": "o_orderdate"}, dates.distinct()
    ).select("o_orderkey", "order_date_local")
    lines = calendar.add_roles(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"), {"ship": "l_shipdate"}, dates.distinct()
    )
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "order_date_local", "ship_date_local"
    )


@query(
    "role_times",
    """
    WITH e AS (SELECT event_id, CASE WHEN event_type = 'error' THEN ts ELSE date_trunc('second', ts) END AS utc FROM events),
         both_clocks AS (SELECT event_id, utc, utc + INTERVAL 7 HOUR AS loc FROM e
                         WHERE utc = date_trunc('second', utc))
    SELECT event_id,
           CAST(strftime(loc, '%Y%m%d') AS INTEGER) AS seen_date_local,
           CAST(strftime(utc, '%Y%m%d') AS INTEGER) AS seen_date_utc,
           CAST(hour(loc) * 3600 + minute(loc) * 60 + second(loc) AS INTEGER) AS seen_time_local,
           CAST(hour(utc) * 3600 + minute(utc) * 60 + second(utc) AS INTEGER) AS seen_time_utc
    FROM both_clocks
    """,
)
def role_times(t):
    """Events with whole seconds find their time; errors keep sub-seconds and drop out."""
    seen = F.when(F.col("event_type") == "error", F.col("ts").cast("timestamp")).otherwise(
        clock.whole_seconds(F.col("ts"))
    )
    dates = calendar.dim_date_over(t.events, "ts", zone=JAKARTA)
    events = t.events.select("event_id", seen.alias("seen_at"))
    return calendar.add_roles(events, {"seen": "seen_at"}, dates, calendar.dim_time(t.spark), zone=JAKARTA).select(
        "event_id", "seen_date_local", "seen_date_utc", "seen_time_local", "seen_time_utc"
    )


@query(
    "local_utc",
    """
    SELECT event_id, (ts + INTERVAL 7 HOUR)::DATE AS day_local, ts::DATE AS day_utc,
           strftime(ts + INTERVAL 7 HOUR, '%H:%M:%S.%f') AS time_local, strftime(ts, '%H:%M:%S.%f') AS time_utc
    FROM events
    """,
)
def local_utc(t):
    ts = F.col("ts")
    return t.events.select(
        "event_id",
        clock.local_date(ts, JAKARTA).alias("day_local"),
        clock.local_date(ts).alias("day_utc"),
        clock.clock_text(ts, JAKARTA).alias("time_local"),
        clock.clock_text(ts).alias("time_utc"),
    )


@query(
    "delays",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, date_diff('second', o_orderdate, l_shipdate) AS delay_seconds,
           date_diff('day', o_orderdate, l_shipdate) AS delay_days
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    """,
)
def delays(t):
    orders = t.orders.select("o_orderkey", "o_orderdate")
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")
    interval = clock.elapsed(F.col("o_orderdate"), F.col("l_shipdate"))
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        clock.elapsed_seconds(F.col("o_orderdate"), F.col("l_shipdate")).alias("delay_seconds"),
        F.extract(F.lit("DAY"), interval).cast("bigint").alias("delay_days"),
    )


@query("count_capacity", "SELECT p_brand, count(p_name) AS capacity FROM part GROUP BY 1")
def count_capacity(t):
    return counts.count_per_key(t.part, "p_brand", "p_name", "capacity")


@query(
    "count_filtered",
    """
    SELECT o_orderkey, count(nullif(l_returnflag, 'N')) AS lines
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' GROUP BY 1
    """,
)
def count_filtered(t):
    """Lines are counted per order before the join, so a huge order is one row by then."""
    lines = t.lineitem.select("l_orderkey", F.nullif("l_returnflag", F.lit("N")).alias("flag"))
    lines = counts.count_per_key(lines, "l_orderkey", "flag", "lines")
    finished = t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey")
    return finished.join(lines, finished["o_orderkey"] == lines["l_orderkey"]).select("o_orderkey", "lines")


@query("row_count", "SELECT count(*) AS rows FROM lineitem")
def row_count(t):
    return counts.row_count(t.lineitem)
