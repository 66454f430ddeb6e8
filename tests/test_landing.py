import datetime as dt
import decimal
import json
import random

import pytest
from failures import JOB_FAILURE
from fleet import ROWS, frames
from pyspark.sql import functions as F

from skyledger.schemas import TABLES
from skyledger.sources import sqltext
from skyledger.sources.extract import extract, jdbc_options, jdbc_source, parquet_source, plan_splits, table_source, touched_on
from skyledger.sources.landing import landing_path, read_csv, read_json, to_landing, write_csv, write_json


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_paths():
    assert landing_path("/x", "flights") == "/x/full/flights"
    assert landing_path("/x", "flights", True, "2024-03-01") == "/x/daily/flights/dt=2024-02-29"


@pytest.mark.parametrize("name", list(TABLES))
def test_csv_round_trip_of_every_table(spark, tmp_path, name):
    table, df = TABLES[name], frames(spark)[name]
    write_csv(to_landing(df, table), str(tmp_path / name))
    back = read_csv(spark, str(tmp_path / name), table.schema, table)
    assert [(f.name, f.dataType) for f in back.schema.fields] == [(f.name, f.dataType) for f in df.schema.fields]
    assert rows(back) == rows(df)


def test_text_survives_csv(spark, tmp_path):
    texts = ["0005", " blank ends ", None, 'quo"te', "com,ma", "line\nbreak", "cr\r\nlf", "back\\slash", "\\", "ünï", '"', "#x"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    write_csv(df, str(tmp_path / "t"))
    assert rows(read_csv(spark, str(tmp_path / "t"), df.schema)) == rows(df)


def test_empty_text_is_missing_after_csv(spark, tmp_path):
    """As with the CSV readers that staging data came through before."""
    df = spark.createDataFrame([(1, ""), (2, "x")], "i int, t string")
    write_csv(df, str(tmp_path / "t"))
    assert rows(read_csv(spark, str(tmp_path / "t"), df.schema)) == [(1, None), (2, "x")]


def test_files_stay_short(spark, tmp_path):
    write_csv(spark.range(1000).coalesce(1), str(tmp_path / "t"), rows_per_file=100)
    assert len(list((tmp_path / "t").glob("part-*.csv"))) == 10
    assert read_csv(spark, str(tmp_path / "t"), spark.range(1).schema).count() == 1000


def test_one_file_of_another_program(spark, tmp_path):
    """Columns in another order, a missing column, and quoting as other CSV writers do it."""
    city = json.dumps({"ru": None, "en": 'A "q", b'})
    quoted = '"' + city.replace('"', '""') + '"'
    (tmp_path / "a.csv").write_text(
        "city,airport_code,coordinates,updated_at\n" f'{quoted},CGK ,"(106.65,-6.125)",2024-01-15 10:00:00.5\n'
    )
    table = TABLES["airports_data"]
    df = read_csv(spark, str(tmp_path / "a.csv"), table.schema, table)
    row = df.first().asDict()
    assert row["airport_code"] == "CGK" and row["city"] == r'{"en":"A \"q\", b","ru":null}'
    assert tuple(row["coordinates"]) == (106.65, -6.125)
    assert row["updated_at"] == dt.datetime(2024, 1, 15, 10, 0, 0, 500000) and "timezone" not in row


def test_files_with_other_headers_are_read_by_name(spark, tmp_path):
    """Read by position they would exchange the two airports; a column that a file lacks is missing."""
    (tmp_path / "a.csv").write_text("flight_id,departure_airport,arrival_airport\n1,CGK,DPS\n")
    (tmp_path / "b.csv").write_text('"flight_id","arrival_airport",departure_airport\n2,CGK,DPS\n')
    (tmp_path / "c.csv").write_text("status,flight_id\nArrived,3\n")
    (tmp_path / "d.csv").write_text("flight_id,departure_airport,arrival_airport\n4,SUB,CGK\n")
    (tmp_path / "_hidden.csv").write_text("x\n1\n")
    got = read_csv(spark, str(tmp_path), TABLES["flights"].schema)
    columns = ("flight_id", "departure_airport", "arrival_airport", "status")
    assert rows(got.select(*columns)) == [(1, "CGK", "DPS", None), (2, "DPS", "CGK", None), (3, None, None, "Arrived"), (4, "SUB", "CGK", None)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 3
    (tmp_path / "e.csv").write_text("flight_id,flight_id\n1,2\n")
    with pytest.raises(ValueError, match="twice"):
        read_csv(spark, str(tmp_path), TABLES["flights"].schema)


def test_json_null_is_missing_where_a_column_may_be(spark, tmp_path):
    df = spark.sql("SELECT '1' AS ticket_no, 'null' AS contact_data UNION ALL SELECT '2', '{\"a\":1}'")
    got = {r.ticket_no: r.contact_data for r in to_landing(df, TABLES["tickets"]).collect()}
    assert got == {"1": None, "2": '{"a":1}'}


def test_unknown_column_and_bad_value_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("flight_id,extra\n1,2\n")
    with pytest.raises(ValueError, match="extra"):
        read_csv(spark, str(tmp_path / "a.csv"), TABLES["flights"].schema)
    (tmp_path / "b.csv").write_text("flight_id\nnot a number\n")
    with pytest.raises(JOB_FAILURE):
        read_csv(spark, str(tmp_path / "b.csv"), TABLES["flights"].schema).collect()


def test_nested_json_missing_documents_and_nan(spark):
    df = spark.sql(
        "SELECT '1' AS ticket_no, map('phone', '+1') AS contact_data UNION ALL "
        "SELECT '2', map() UNION ALL SELECT '3', NULL"
    )
    got = {r.ticket_no: r.contact_data for r in to_landing(df, TABLES["tickets"]).collect()}
    assert got == {"1": '{"phone":"+1"}', "2": None, "3": None}
    nan = spark.sql("SELECT double('NaN') AS flight_id UNION ALL SELECT 1.5D")
    assert sorted((r.flight_id for r in to_landing(nan, TABLES["flights"]).collect()), key=str) == [1.5, None]


def test_json_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", None), (2, None, 2.5)], "i int, t string, d double")
    write_json(df, str(tmp_path / "j"))
    assert rows(read_json(spark, str(tmp_path / "j"), df.schema)) == rows(df)


def stamped(spark):
    day = lambda d, h=12: dt.datetime(2024, 1, d, h)
    data = [
        ("created before", day(13), day(13)), ("created on", day(15), day(17)), ("created after", day(16), day(16)),
        ("updated on", day(10), day(15)), ("first moment", day(15, 0), day(15, 0)), ("next midnight", day(16, 0), day(16, 0)),
        ("no stamps", None, None), ("only created", day(15), None),
    ]
    return spark.createDataFrame(data, "what string, created_at timestamp_ntz, updated_at timestamp_ntz")


def test_day_window(spark):
    got = {r.what for r in extract(lambda _: stamped(spark), "t", True, "2024-01-16").collect()}
    assert got == {"created on", "updated on", "first moment", "only created"}
    assert extract(lambda _: stamped(spark), "t").count() == 8
    with pytest.raises(ValueError):
        extract(lambda _: stamped(spark), "t", True)


def test_day_window_reaches_the_scan(spark, tmp_path):
    stamped(spark).write.parquet(f"{tmp_path}/t")
    source = parquet_source(spark, str(tmp_path))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = touched_on(source("t"), dt.date(2024, 1, 15))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters:")[1]
    assert "GreaterThanOrEqual(created_at" in pushed and "LessThan(updated_at" in pushed
    assert "cast(created_at" not in plan


def test_table_source(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS src LOCATION '{tmp_path}/src'")
    try:
        spark.range(3).write.saveAsTable("src.numbers")
        assert extract(table_source(spark, "src"), "numbers").count() == 3
    finally:
        spark.sql("DROP DATABASE src CASCADE")


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "s.t", user="u")
    assert plain == {"url": "jdbc:x", "dbtable": "s.t", "fetchsize": "10000", "user": "u"}
    split = jdbc_options("jdbc:x", "s.t", {"column": "flight_id", "lower": 1, "upper": 9, "count": 4})
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("flight_id", "1", "9", "4")


def test_jdbc_source_names_the_missing_driver(spark):
    with pytest.raises(Exception, match="(?i)driver"):
        jdbc_source(spark, "jdbc:nosuch:db", "bookings", single=True)("flights")


def test_a_scan_by_one_task_has_to_be_asked_for(spark):
    for single in (False, ["tickets"]):
        with pytest.raises(ValueError, match="one task"):
            jdbc_source(spark, "jdbc:nosuch:db", "bookings", single=single)("flights")
    with pytest.raises(Exception, match="(?i)driver"):
        jdbc_source(spark, "jdbc:nosuch:db", "bookings", predicates={"flights": ["flight_id < 1"]})("flights")


KEYS = {
    "string": ["", "a", "A", "'", "o'x", "é", "漢", "zz", "a b", "\\", "%", "0005432000987"],
    "int": [-(2**31), -1, 0, 1, 7, 2**31 - 1],
    "bigint": [-(2**63), 0, 5, 2**63 - 1],
    "date": [dt.date(1, 1, 1), dt.date(2024, 2, 29), dt.date(9999, 12, 31)],
    "timestamp_ntz": [dt.datetime(2024, 1, 1, 0, 0, 0, 1), dt.datetime(1970, 1, 1), dt.datetime(2030, 5, 5, 23, 59, 59, 999999)],
    "decimal(10,2)": [decimal.Decimal("-1.50"), decimal.Decimal("0.00"), decimal.Decimal("12345678.90")],
}


@pytest.mark.parametrize("kind", list(KEYS))
@pytest.mark.parametrize("known", [0, 1, 300])
def test_splits_cover_any_key_once(spark, kind, known):
    """Keys the plan knew, others, and none: each is in exactly one range."""
    rng = random.Random(known)
    value = {
        "string": lambda: "".join(rng.choices("abAB'é漢 0", k=rng.randrange(6))),
        "date": lambda: dt.date(2000, 1, 1) + dt.timedelta(days=rng.randrange(9000)),
        "timestamp_ntz": lambda: dt.datetime(2000, 1, 1) + dt.timedelta(microseconds=rng.randrange(10**15)),
        "decimal(10,2)": lambda: decimal.Decimal(rng.randrange(-10**6, 10**6)) / 100,
    }.get(kind, lambda: rng.randrange(-1000, 1000))
    last = spark.createDataFrame([(value(),) for _ in range(known)] + [(None,)], f"k {kind}")
    splits = plan_splits(last, "k", 6, collation="UTF8_BINARY")
    assert 1 <= len(splits) <= 6 and (known < 300 or len(splits) >= 4)
    rows = spark.createDataFrame([(v,) for v in [*KEYS[kind], *(value() for _ in range(200)), None]], f"k {kind}")
    hits = sum((F.when(F.expr(s), 1).otherwise(0) for s in splits), F.lit(0))
    assert rows.where(hits != 1).collect() == []


def test_sql_files(spark, tmp_path):
    (tmp_path / "q.sql").write_text("SELECT id FROM range(10) WHERE id >= :low")
    assert sqltext.sql_file_frame(spark, str(tmp_path / "q.sql"), {"low": 7}).count() == 3
    assert sqltext.transform_by_name(spark, str(tmp_path), "q", {"low": 8}).count() == 2
    with pytest.raises(FileNotFoundError, match="flights"):
        sqltext.transform_by_name(spark, str(tmp_path), "flights")
    (tmp_path / "c.sql").write_text(f"CREATE TABLE made USING parquet LOCATION '{tmp_path}/made' AS SELECT id, 'a' AS t FROM range(2)")
    (tmp_path / "i.sql").write_text("INSERT INTO made SELECT id, t FROM {rows}")
    try:
        sqltext.run_sql_file(spark, str(tmp_path / "c.sql"))
        more = spark.range(5, 7).select(F.lit("b").alias("t"), "id")
        sqltext.insert_frame(spark, str(tmp_path / "i.sql"), more)
        sqltext.append_rows(more, "made")
        assert rows(spark.table("made")) == [(0, "a"), (1, "a"), (5, "b"), (5, "b"), (6, "b"), (6, "b")]
    finally:
        spark.sql("DROP TABLE IF EXISTS made")


def test_fixture_covers_every_table():
    assert set(ROWS) == set(TABLES)
