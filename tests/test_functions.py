import datetime as dt

import pytest
from failures import JOB_FAILURE
from pyspark.sql import functions as F

from skyledger.functions import clock, values


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def test_local_day_crosses_midnight(spark):
    ts = F.lit("2024-01-15 22:00:00Z").cast("timestamp")
    row = one(
        spark,
        local=clock.local_date(ts, "Asia/Jakarta"),
        utc=clock.local_date(ts),
        number=clock.day_number(ts, "Asia/Jakarta") - clock.day_number(ts),
        text=clock.clock_text(ts, "Asia/Jakarta"),
        micros=clock.micros_of_day(ts, "Asia/Jakarta"),
    )
    assert row["local"] == dt.date(2024, 1, 16) and row["utc"] == dt.date(2024, 1, 15)
    assert row["number"] == 1 and row["text"] == "05:00:00.000000" and row["micros"] == 5 * 3600 * 10**6


def test_time_of_day_before_1970_is_positive(spark):
    ts = F.lit("1969-12-31 23:59:59.5Z").cast("timestamp")
    assert one(spark, m=clock.micros_of_day(ts))["m"] == 86_399_500_000


def test_clock_text_and_micros_are_inverse(spark):
    ts = F.lit("2024-01-15 10:11:12.345678Z").cast("timestamp")
    row = one(spark, a=clock.micros_of_day(ts), b=clock.clock_micros(clock.clock_text(ts)))
    assert row["a"] == row["b"]


def test_elapsed_may_be_negative(spark):
    late, early = (F.lit(f"2024-01-15 {t}Z").cast("timestamp") for t in ("10:00:30", "09:58:00"))
    row = one(spark, i=clock.elapsed(late, early), s=clock.elapsed_seconds(late, early))
    assert row["i"] == dt.timedelta(seconds=-150) and row["s"] == -150


def test_data_day():
    assert clock.data_day("2024-03-01") == dt.date(2024, 2, 29)
    assert clock.data_day(dt.datetime(2024, 1, 1, 5)) == dt.date(2023, 12, 31)


def test_json_field(spark):
    row = one(
        spark,
        text=values.json_field(F.lit(r'{"en":"A \"q\", b","ru":null}'), "en"),
        null=values.json_field(F.lit('{"ru":null}'), "ru"),
        absent=values.json_field(F.lit('{"en":1}'), "x"),
        number=values.json_field(F.lit('{"en":87}'), "en"),
        no_input=values.json_field(F.lit(None).cast("string"), "en"),
    )
    assert row == {"text": 'A "q", b', "null": None, "absent": None, "number": "87", "no_input": None}


def test_canonical_json_ignores_key_order_and_keeps_last_duplicate(spark):
    row = one(
        spark,
        a=values.canonical_json(F.lit('{"b": 1, "a": {"d": 2, "c": 3}}')),
        b=values.canonical_json(F.lit('{"a":{"c":3,"d":2},"b":1}')),
        dup=values.canonical_json(F.lit('{"a":1,"a":2}')),
        null=values.canonical_json(F.lit(None).cast("string")),
    )
    assert row["a"] == row["b"] == '{"a":{"c":3,"d":2},"b":1}'
    assert row["dup"] == '{"a":2}' and row["null"] is None


def test_malformed_json_fails(spark):
    with pytest.raises(JOB_FAILURE):
        spark.createDataFrame([("{",)], "j string").select(values.canonical_json(F.col("j"))).collect()


def test_json_document_serialises_nested_values(spark):
    df = spark.sql("SELECT named_struct('en', 'X', 'ru', 'Y') AS s, map('k', 1) AS m, '{}' AS e")
    types = {f.name: f.dataType for f in df.schema.fields}
    row = df.select(
        values.json_document(F.col("s"), types["s"]).alias("s"),
        values.json_document(F.col("m"), types["m"]).alias("m"),
        values.json_document(F.col("e"), types["e"], empty_is_null=True).alias("e"),
        values.json_document(F.col("e"), types["e"]).alias("kept"),
    ).first()
    assert tuple(row) == ('{"en":"X","ru":"Y"}', '{"k":1}', None, "{}")


def test_point_text_round_trip(spark):
    row = one(
        spark,
        p=values.point_from_text(F.lit("(106.65, -6.125)")),
        t=values.point_to_text(values.point_from_text(F.lit("(106.65,-6.125)"))),
        n=values.point_from_text(F.lit(None).cast("string")),
    )
    assert tuple(row["p"]) == (106.65, -6.125) and row["t"] == "(106.65,-6.125)" and row["n"] is None


def test_stable_id_depends_on_table_and_key_only(spark):
    key = F.lit("A")
    row = one(spark, a=values.stable_id("x", key), b=values.stable_id("x", key), c=values.stable_id("y", key))
    assert row["a"] == row["b"] != row["c"] and [len(p) for p in row["a"].split("-")] == [8, 4, 4, 4, 12]


def test_key_texts_are_unambiguous(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a\\", "|c"), ("a\\|", "c"), ("a", "c")], "x string, y string")
    rows = df.select(values.key_text(F.col("x"), F.col("y")).alias("k"), values.stable_id("t", F.col("x"), F.col("y")).alias("id")).collect()
    assert len({r.k for r in rows}) == len({r.id for r in rows}) == 5
    assert rows[4].k == "a|c"
