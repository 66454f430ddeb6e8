"""The physical plans are the ones the design asks for."""

import datetime as dt
import re

import pytest
from fleet import frames
from pyspark.sql import functions as F

from driver_queries import QUERIES
from skyledger.operators.calendar import add_roles, dim_date, dim_time
from skyledger.operators.joins import lookup
from skyledger.operators.quality import batch_violations, orphan_keys, table_violations
from skyledger.plans import dimensions, facts
from skyledger.schemas import TABLES

TINY = "/root/testdata/sf0.001"


def planned(df):
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def executed(df):
    df.collect()
    return planned(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Staging tables and dimensions read from Parquet, as in a daily run."""
    root = tmp_path_factory.mktemp("stored")
    stg = frames(spark)
    for name, df in stg.items():
        df.write.parquet(f"{root}/{name}")
    stg = {name: spark.read.parquet(f"{root}/{name}") for name in stg}
    span = dt.date(2024, 1, 1), dt.date(2024, 1, 31)
    calendars = {"dim_date": dim_date(spark, *span), "dim_time": dim_time(spark)}
    for name, df in calendars.items():
        df.write.parquet(f"{root}/{name}")
    dims = {name: spark.read.parquet(f"{root}/{name}") for name in calendars}
    dims["dim_aircrafts"] = dimensions.dim_aircrafts(stg)
    dims["dim_airport"] = dimensions.dim_airport(stg)
    dims["dim_passenger"] = dimensions.dim_passenger(stg)
    return stg, dims


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_boarding_pass_hashes_the_large_tables_once(stored, no_broadcast):
    """Tickets, segments and passes by ticket_no, then the result and the flights by flight_id."""
    plan = planned(facts.fct_boarding_pass(*stored))
    assert plan.count("Exchange hashpartitioning(ticket_no,") == 3
    assert plan.count("Exchange hashpartitioning(flight_id,") == 2
    assert plan.count("Exchange hashpartitioning(passenger_id,") == 2
    # Without broadcasts each lookup of a place costs two more, of flights and of the dimension.
    assert plan.count("Exchange hashpartitioning") == 7 + 2 * 3


def test_lookups_run_on_flights_and_not_on_segments(stored, no_broadcast):
    """No broadcast join sits above the joins of the large tables."""
    for build in (facts.fct_boarding_pass, facts.fct_booking_ticket):
        plan = planned(build(*stored))
        top = plan.index("SortMergeJoin [flight_id]")
        assert "BroadcastHashJoin" not in plan[:top] and "BroadcastHashJoin" in plan[top:]


def test_occupancy_shuffles_counts_instead_of_passes(stored):
    plan = planned(facts.fct_seat_occupied_daily(*stored))
    assert re.search(r"Exchange hashpartitioning\(flight_id, \d+\)[^\n]*\n[^\n]*partial_count\(seat_no\)", plan)


def test_scans_read_only_what_is_used(stored):
    plan = planned(facts.fct_boarding_pass(*stored))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)", plan)
    assert not any("contact_data" in s or "passenger_name" in s or "amount" in s for s in schemas)


def test_status_filter_reaches_the_scan(stored):
    assert "EqualTo(status,Arrived)" in planned(facts.fct_seat_occupied_daily(*stored))


def test_all_roles_share_one_broadcast_per_dimension(spark, stored):
    stg, dims = stored
    df = add_roles(
        stg["flights"].select("flight_id", *facts.PLANNED),
        {r: r for r in facts.PLANNED},
        dims["dim_date"],
        dims["dim_time"],
        zone="Asia/Jakarta",
    )
    plan = executed(df)
    assert plan.count("BroadcastHashJoin") == 8 and plan.count("ReusedExchange") == 6


def test_utc_needs_half_the_lookups(stored):
    stg, dims = stored
    df = add_roles(stg["flights"], {r: r for r in facts.PLANNED}, dims["dim_date"], dims["dim_time"])
    assert planned(df).count("BroadcastHashJoin") == 4
    row = df.first()
    assert row["scheduled_departure_time_local"] == row["scheduled_departure_time_utc"]


def test_only_calendars_are_broadcast_by_hint(spark, tmp_path):
    """A dimension of few bytes on disk and many rows is left to what the exchange measures."""
    spark.range(3_000_000).select(F.col("id").alias("k"), F.lit("x").alias("v")).write.parquet(f"{tmp_path}/dim")
    dim = spark.read.parquet(f"{tmp_path}/dim")
    df = lookup(spark.range(10).withColumnRenamed("id", "on"), dim, "k", "v", "on", "name")
    assert "Hint" not in df._jdf.queryExecution().analyzed().toString()
    assert df.count() == 10


def test_parents_are_reduced_before_their_exchange(spark, tmp_path):
    """The references' bitmap meets the parent at its scan, below any exchange of it."""
    spark.range(100_000).select(F.col("id").alias("k")).write.parquet(f"{tmp_path}/p")
    spark.range(50).select((F.col("id") * 4000).alias("k")).write.parquet(f"{tmp_path}/c")
    found = orphan_keys(spark.read.parquet(f"{tmp_path}/c"), spark.read.parquet(f"{tmp_path}/p"), ["k"])
    assert sorted(r.k for r in found.collect()) == [4000 * i for i in range(25, 50)]
    plan = planned(orphan_keys(spark.read.parquet(f"{tmp_path}/c"), spark.read.parquet(f"{tmp_path}/p"), ["k"]))
    above = plan[plan.index("LeftAnti") : plan.index(f"{tmp_path}/p"[:12], plan.index("getbit"))]
    assert "bitmap_construct_agg" in plan and "hashpartitioning" not in above


def test_only_batches_send_bitmaps_of_their_references(stored):
    """All references of a large table would fill a bitmap; those of a batch leave most of the parent out."""
    stg, table = stored[0], TABLES["ticket_flights"]
    batch = stg["ticket_flights"].select(*table.key).limit(3)
    whole = planned(table_violations(table, stg))
    first = planned(batch_violations(table, stg["ticket_flights"], None, stg, {}))
    later = planned(batch_violations(table, stg["ticket_flights"], batch, stg, {}))
    assert [x.count("LeftAnti") for x in (whole, first, later)] == [2, 2, 2]
    assert ["bitmap_construct_agg" in x for x in (whole, first, later)] == [False, False, True]


# Whole daily runs, whose last plan says little, and the one source that is written in Python.
OTHERS = ("_cycle", "_stream", "_status", "_shipped", "_waves", "_profile", "_day", "_by_name", "dump_roundtrip")


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.endswith(OTHERS)])
def test_no_python_and_no_cartesian_product(spark, name):
    plan = planned(QUERIES[name](spark, TINY))
    for word in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin", "ObjectHashAggregate"):
        assert word not in plan, word


def test_hot_ticket_and_hot_flight_are_split(spark, tmp_path, stored):
    """A third of all segments on one ticket: the join of that ticket runs in several tasks."""
    small_stg, dims = stored
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        n = 60_000
        number = lambda c: F.lpad(c.cast("string"), 13, "0")
        tickets = spark.range(n).select(
            number(F.col("id")).alias("ticket_no"),
            F.lit("00000A").alias("book_ref"),
            F.col("id").cast("string").alias("passenger_id"),
            F.lit("N").alias("passenger_name"),
            F.lit(None).cast("string").alias("contact_data"),
            F.md5(F.col("id").cast("string")).alias("id"),
        )
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % n)
        segments = spark.range(3 * n).select(
            number(hot).alias("ticket_no"),
            F.col("id").cast("int").alias("flight_id"),
            F.md5(F.col("id").cast("string")).alias("fare_conditions"),
        )
        passes = segments.select("ticket_no", "flight_id", F.lit(1).alias("boarding_no"), F.lit("1A").alias("seat_no"))
        first = small_stg["flights"].where("flight_id = 1").first().asDict()
        types = dict(small_stg["flights"].dtypes)
        same = [F.lit(v).cast(types[c]).alias(c) for c, v in first.items() if c != "flight_id"]
        flights = spark.range(3 * n).select(F.col("id").cast("int").alias("flight_id"), *same)
        stg = dict(small_stg)
        for name, df in dict(tickets=tickets, ticket_flights=segments, boarding_passes=passes, flights=flights).items():
            df.repartition(8).write.parquet(f"{tmp_path}/{name}")
            stg[name] = spark.read.parquet(f"{tmp_path}/{name}")
        df = facts.fct_boarding_pass(stg, {**dims, "dim_passenger": dimensions.dim_passenger(stg)})
        df.write.parquet(f"{tmp_path}/out")
        assert spark.read.parquet(f"{tmp_path}/out").count() == 3 * n
        assert "skew=true" in executed(df)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
