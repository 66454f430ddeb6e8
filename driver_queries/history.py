"""Upserts and type-2 histories."""

import datetime as dt

from pyspark.sql import functions as F

from driver_queries.airline import STAGING_SQL, staging
from driver_queries.registry import query
from skyledger.operators import keyindex
from skyledger.operators.digests import changed_parts, snapshot_changes_by_digest
from skyledger.operators.joins import as_of_lookup, latest_per_key
from skyledger.operators.snapshot import snapshot_changes, snapshot_check, snapshot_step, visible_versions
from skyledger.operators.upsert import upsert
from skyledger.plans.staging import upsert_table
from skyledger.schemas import TABLES
from skyledger.session import scratch_path
from skyledger.sources.store import Store

FIRST = dt.datetime(2024, 1, 15, 6)
SECOND = dt.datetime(2024, 1, 16, 6, 30)
THIRD = dt.datetime(2024, 1, 17, 6)

_UPSERT_SQL = """
    WITH base AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'),
         batch AS (SELECT c_custkey, c_acctbal + 1 AS c_acctbal, nullif(c_mktsegment, 'FURNITURE') AS c_mktsegment
                   FROM customer WHERE c_acctbal < 2500)
    SELECT base.* FROM base WHERE c_custkey NOT IN (SELECT c_custkey FROM batch)
    UNION ALL
    SELECT c_custkey, base.c_name, batch.c_acctbal, batch.c_mktsegment FROM base JOIN batch USING (c_custkey)
    UNION ALL
    SELECT c_custkey, 'new' AS c_name, c_acctbal, c_mktsegment FROM batch
    WHERE c_custkey NOT IN (SELECT c_custkey FROM base)
"""


def _customer_upsert(t):
    base = t.customer.where("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    batch = t.customer.where("c_acctbal < 2500").select(
        "c_custkey",
        (F.col("c_acctbal") + 1).alias("c_acctbal"),
        F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("c_mktsegment"),
    )
    return upsert(base, batch, ["c_custkey"], {"c_name": F.lit("new")})


@query("upsert_single", _UPSERT_SQL)
def upsert_single(t):
    return _customer_upsert(t)


@query("upsert_large_batch", _UPSERT_SQL)
def upsert_large_batch(t):
    """The same upsert once more: there is one plan for batches of any size."""
    return _customer_upsert(t)


_LATEST_LINES_SQL = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag, l_shipdate FROM lineitem {where}
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey DESC, l_quantity DESC, l_returnflag DESC) = 1
"""
_LINE_KEY = ["l_orderkey", "l_linenumber"]


def _lines(t):
    return t.lineitem.select(*_LINE_KEY, "l_partkey", "l_quantity", "l_returnflag", "l_shipdate")


@query("latest_per_key", _LATEST_LINES_SQL.format(where=""))
def latest_lines(t):
    return latest_per_key(_lines(t), _LINE_KEY, "l_shipdate")


@query(
    "upsert_composite",
    f"""
    WITH base AS ({_LATEST_LINES_SQL.format(where="WHERE l_returnflag <> 'R'")}),
         batch AS ({_LATEST_LINES_SQL.format(where="WHERE l_returnflag = 'R'")})
    SELECT * FROM batch
    UNION ALL
    SELECT base.* FROM base ANTI JOIN batch USING (l_orderkey, l_linenumber)
    """,
)
def upsert_composite(t):
    """Returned lines replace the others; repeated lines of a batch are settled by ship date."""
    returned = F.col("l_returnflag") == "R"
    base = latest_per_key(_lines(t).where(~returned), _LINE_KEY, "l_shipdate")
    return upsert(base, _lines(t).where(returned), _LINE_KEY, on_duplicates="latest", order_by="l_shipdate")


def _customers(t):
    return t.customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")


def _first_load(t):
    return _customers(t).where("c_acctbal >= 0")


def _second_load(t):
    """Indebted customers are new, BUILDING ones vanish, MACHINERY ones change, one column to NULL."""
    return _customers(t).where("c_mktsegment <> 'BUILDING'").select(
        "c_custkey",
        "c_nationkey",
        F.when(F.col("c_mktsegment") == "MACHINERY", F.col("c_acctbal") * 2).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.nullif("c_mktsegment", F.lit("HOUSEHOLD")).alias("c_mktsegment"),
    )


_FIRST_SQL = "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal >= 0"
_SECOND_SQL = """
    SELECT c_custkey, c_nationkey,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal,
           nullif(c_mktsegment, 'HOUSEHOLD') AS c_mktsegment
    FROM customer WHERE c_mktsegment <> 'BUILDING'
"""


def _version(at: str, closed: str | None = None) -> str:
    end = f"TIMESTAMP '{closed}'" if closed else "CAST(NULL AS TIMESTAMP)"
    return (
        f"md5(c_custkey || '|{at}') AS dbt_scd_id, TIMESTAMP '{at}' AS dbt_updated_at, "
        f"TIMESTAMP '{at}' AS dbt_valid_from, {end} AS dbt_valid_to"
    )


_AT1, _AT2, _AT3 = "2024-01-15 06:00:00", "2024-01-16 06:30:00", "2024-01-17 06:00:00"
_CHANGED = "(l2.c_acctbal IS DISTINCT FROM l1.c_acctbal OR l2.c_mktsegment IS DISTINCT FROM l1.c_mktsegment)"
_TWO_RUNS_SQL = f"""
    WITH l1 AS ({_FIRST_SQL}), l2 AS ({_SECOND_SQL})
    SELECT l1.*, {_version(_AT1).replace('md5(c_custkey', 'md5(l1.c_custkey')}
    FROM l1 LEFT JOIN l2 ON l2.c_custkey = l1.c_custkey WHERE l2.c_custkey IS NULL OR NOT {_CHANGED}
    UNION ALL
    SELECT l1.*, {_version(_AT1, _AT2).replace('md5(c_custkey', 'md5(l1.c_custkey')}
    FROM l1 JOIN l2 ON l2.c_custkey = l1.c_custkey WHERE {_CHANGED}
    UNION ALL
    SELECT l2.*, {_version(_AT2).replace('md5(c_custkey', 'md5(l2.c_custkey')}
    FROM l2 LEFT JOIN l1 ON l2.c_custkey = l1.c_custkey WHERE l1.c_custkey IS NULL OR {_CHANGED}
"""

KEY = ["c_custkey"]


def _two_runs(t):
    return snapshot_check(snapshot_check(None, _first_load(t), KEY, FIRST), _second_load(t), KEY, SECOND)


@query("scd2_first", f"WITH l1 AS ({_FIRST_SQL}) SELECT *, {_version(_AT1)} FROM l1")
def scd2_first(t):
    return snapshot_check(None, _first_load(t), KEY, FIRST)


@query("scd2_change", _TWO_RUNS_SQL)
def scd2_change(t):
    return _two_runs(t)


@query("scd2_same", _TWO_RUNS_SQL)
def scd2_same(t):
    """The second load a second time: nothing happens."""
    return snapshot_check(_two_runs(t), _second_load(t), KEY, THIRD)


@query(
    "scd2_vanished",
    f"""
    WITH l1 AS (SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer)
    SELECT *, {_version(_AT1)} FROM l1
    """,
)
def scd2_vanished(t):
    """Keys that are missing from the second load stay open."""
    history = snapshot_check(None, _customers(t), KEY, FIRST)
    return snapshot_check(history, _first_load(t), KEY, SECOND)


@query(
    "scd2_check_list",
    f"""
    WITH l1 AS ({_FIRST_SQL})
    SELECT *, {_version(_AT1)} FROM l1
    UNION ALL
    SELECT *, {_version(_AT2)} FROM ({_SECOND_SQL}) l2 WHERE c_custkey NOT IN (SELECT c_custkey FROM l1)
    """,
)
def scd2_check_list(t):
    """Only the nation is compared; balances and segments differ without effect."""
    history = snapshot_check(None, _first_load(t), KEY, FIRST, check_cols=["c_nationkey"])
    return snapshot_check(history, _second_load(t), KEY, SECOND, check_cols=["c_nationkey"])


@query("scd2_current", f"SELECT c_custkey, c_acctbal, dbt_valid_from FROM ({_TWO_RUNS_SQL}) h WHERE dbt_valid_to IS NULL")
def scd2_current(t):
    return visible_versions(_two_runs(t), "current").select("c_custkey", "c_acctbal", "dbt_valid_from")


@query("scd2_stored", _TWO_RUNS_SQL)
def scd2_stored(t):
    """The two runs written to and read from a store, closed versions apart from open ones."""
    store = Store(t.spark, scratch_path(t.spark, "store"))
    store.write_history("final.customers", snapshot_step(None, _first_load(t), KEY, FIRST))
    step = snapshot_step(store.read_open("final.customers"), _second_load(t), KEY, SECOND)
    store.write_history("final.customers", step)
    return store.read_history("final.customers")


@query(
    "scd2_composite",
    f"""
    WITH l1 AS ({_LATEST_LINES_SQL.format(where="")}),
         v AS (SELECT *, md5(l_orderkey || '|' || l_linenumber || '|{_AT1}') AS dbt_scd_id,
                      TIMESTAMP '{_AT1}' AS dbt_updated_at, TIMESTAMP '{_AT1}' AS dbt_valid_from FROM l1)
    SELECT *, CASE WHEN l_returnflag = 'A' THEN TIMESTAMP '{_AT2}' END AS dbt_valid_to FROM v
    UNION ALL
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity + 1, l_returnflag, l_shipdate,
           md5(l_orderkey || '|' || l_linenumber || '|{_AT2}'), TIMESTAMP '{_AT2}', TIMESTAMP '{_AT2}', CAST(NULL AS TIMESTAMP)
    FROM l1 WHERE l_returnflag = 'A'
    """,
)
def scd2_composite(t):
    lines = latest_per_key(_lines(t), _LINE_KEY, "l_shipdate")
    more = F.when(F.col("l_returnflag") == "A", F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    history = snapshot_check(None, lines, _LINE_KEY, FIRST)
    return snapshot_check(history, lines.withColumn("l_quantity", more), _LINE_KEY, SECOND)


@query("scd2_changes", _TWO_RUNS_SQL)
def scd2_changes(t):
    """Three runs of which each stores its changes; the last has none, and the second makes a new base."""
    store = Store(t.spark, scratch_path(t.spark, "store"), compact_after=2)
    for at, load in ((FIRST, _first_load), (SECOND, _second_load), (THIRD, _second_load)):
        known = store.read_open("final.customers") if store.exists("final.customers") else None
        store.append_history("final.customers", snapshot_changes(known, load(t), KEY, at))
    return store.read_history("final.customers")


@query(
    "upsert_buckets",
    f"""
    WITH {STAGING_SQL}
    SELECT book_ref, book_date,
           CAST(CASE WHEN o_orderstatus = 'F' THEN total_amount + 1 ELSE total_amount END AS DECIMAL(10, 2)) AS total_amount,
           md5('bookings|' || book_ref) AS id, CASE WHEN o_orderstatus = 'P' THEN TIMESTAMP '{_AT2}' ELSE TIMESTAMP '{_AT1}' END AS created_at,
           CASE WHEN o_orderstatus = 'O' THEN TIMESTAMP '{_AT1}' ELSE TIMESTAMP '{_AT2}' END AS updated_at
    FROM bookings JOIN orders ON book_ref = lpad(o_orderkey::VARCHAR, 10, '0')
    """,
)
def upsert_buckets(t):
    """Open and finished orders, then finished ones raised by one and pending ones new, into key buckets."""
    table = TABLES["bookings"]
    store = Store(t.spark, scratch_path(t.spark, "store"), bucket_bytes=1 << 18)
    every = staging(t, "bookings")["bookings"].drop("id", "created_at", "updated_at")
    status = t.orders.select(F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("book_ref"), "o_orderstatus")
    every = every.join(status, "book_ref")
    raised = F.when(F.col("o_orderstatus") == "F", F.col("total_amount") + 1).otherwise(F.col("total_amount"))
    second = every.withColumn("total_amount", raised.cast("decimal(10,2)")).withColumn("updated_at", F.lit(SECOND).cast("timestamp_ntz"))
    for at, batch in ((FIRST, every.where("o_orderstatus <> 'P'")), (SECOND, second.where("o_orderstatus <> 'O'"))):
        upsert_table(store, table, batch.drop("o_orderstatus"), at)
    digest = F.replace("id", F.lit("-"), F.lit(""))
    return store.read("stg.bookings").withColumns({"book_date": F.col("book_date").cast("timestamp_ntz"), "id": digest})


@query(
    "unique_key_index",
    f"""
    WITH {STAGING_SQL}
    SELECT flight_id, seat_no, count(*) AS rows FROM boarding_passes GROUP BY flight_id, seat_no
    HAVING count(*) > 1 AND bool_or(right(ticket_no, 1) IN ('1', '4', '7'))
    """,
)
def unique_key_index(t):
    """Seats of a flight that a batch of passes takes while another ticket holds them, seen in the key index."""
    columns, key = ("flight_id", "seat_no"), TABLES["boarding_passes"].key
    every = staging(t, "boarding_passes")["boarding_passes"]
    is_late = F.substring("ticket_no", -1, 1).isin("1", "4", "7")
    before, batch = every.where(~is_late), every.where(is_late)
    index = keyindex.entries(before, columns, key)
    changes = keyindex.changed_entries(before, upsert(before, batch, key), batch, columns, key)
    return keyindex.clashes(keyindex.after_changes(index, changes), changes, columns)


_VERSIONS_SQL = """
    versions AS (
        SELECT c_custkey, c_mktsegment || '/' || i AS segment,
               CAST(CASE i WHEN 0 THEN DATE '1900-01-01' WHEN 1 THEN a ELSE b END AS TIMESTAMP) AS valid_from,
               CAST(CASE i WHEN 0 THEN a WHEN 1 THEN b END AS TIMESTAMP) AS valid_to
        FROM (SELECT *, DATE '1993-01-01' + CAST(c_custkey % 700 AS INTEGER) AS a,
                     DATE '1995-06-01' + CAST(c_custkey % 500 AS INTEGER) AS b FROM customer) c,
             (SELECT unnest([0, 1, 2]) AS i) n
        WHERE c_custkey % 11 <> 0 OR i > 0)
"""


@query(
    "as_of_versions",
    f"""
    WITH {_VERSIONS_SQL}
    SELECT o_orderkey, o_custkey, o_orderdate, segment
    FROM orders LEFT JOIN versions ON c_custkey = o_custkey AND valid_from <= o_orderdate
         AND (valid_to IS NULL OR o_orderdate < valid_to)
    """,
)
def as_of_versions(t):
    """Each order with its customer's segment on that day, of three versions; some customers begin late."""
    day = lambda start, spread: F.date_add(F.lit(start).cast("date"), (F.col("c_custkey") % spread).cast("int")).cast("timestamp_ntz")
    a, b = day("1993-01-01", 700), day("1995-06-01", 500)
    cuts = (F.lit("1900-01-01").cast("timestamp_ntz"), a), (a, b), (b, F.lit(None).cast("timestamp_ntz"))
    versions = F.explode(
        F.array(*[F.struct(F.lit(i).alias("i"), f.alias("valid_from"), to.alias("valid_to")) for i, (f, to) in enumerate(cuts)])
    )
    history = t.customer.select("c_custkey", "c_mktsegment", versions.alias("v")).where("c_custkey % 11 <> 0 OR v.i > 0")
    history = history.select("c_custkey", F.concat_ws("/", "c_mktsegment", "v.i").alias("segment"), "v.valid_from", "v.valid_to")
    orders = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"))
    return as_of_lookup(
        orders, history, "c_custkey", "o_custkey", "o_orderdate", {"segment": "segment"}, "valid_from", "valid_to", how="left"
    )


@query(
    "scd2_digest",
    f"""
    WITH l1 AS (SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer),
         top AS (SELECT max(c_custkey) AS k FROM customer)
    SELECT l1.*, {_version(_AT1, _AT2).replace('md5(c_custkey', 'md5(l1.c_custkey')}, CAST(1 AS BIGINT) AS compared FROM l1 JOIN top ON c_custkey = k
    UNION ALL
    SELECT c_custkey, c_nationkey, c_acctbal + 1, c_mktsegment, {_version(_AT2)}, CAST(1 AS BIGINT) FROM l1 JOIN top ON c_custkey = k
    """,
)
def scd2_digest(t):
    """One customer changes: what the run opens and closes, and how many key buckets it had to compare."""
    path = scratch_path(t.spark, "open")
    snapshot_changes(None, _customers(t), KEY, FIRST).write.parquet(path)
    known = t.spark.read.parquet(path)
    top = t.customer.agg(F.max("c_custkey")).scalar()
    new = _customers(t).withColumn("c_acctbal", F.when(F.col("c_custkey") == top, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    compared = changed_parts(known, new, KEY, ["c_nationkey", "c_acctbal", "c_mktsegment"])[2]
    return snapshot_changes_by_digest(known, new, KEY, SECOND).withColumn("compared", F.lit(compared).cast("bigint"))
