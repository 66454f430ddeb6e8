"""Date and time dimensions, and the roles a fact plays with them."""

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import clock


def _date_rows(days: DataFrame) -> DataFrame:
    day = F.col("date_actual")
    number = F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
    return days.select(number.cast("int").alias("date_id"), day)


def dim_date(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from `start` to `end`, both included; date_id is yyyyMMdd."""
    days = (end - start).days + 1
    return _date_rows(
        spark.range(days, numPartitions=1).select(
            F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_actual")
        )
    )


def dim_date_over(df: DataFrame, *columns: str, zone: str = clock.UTC) -> DataFrame:
    """The days spanned by timestamp columns of `df`, with one day of room for zones.

    The span is one aggregate over the data; no row leaves the executors for it.
    """
    days = [clock.local_date(F.col(c), zone) for c in columns]
    low = F.least(*days) if len(days) > 1 else days[0]
    high = F.greatest(*days) if len(days) > 1 else days[0]
    span = df.agg(F.min(low).alias("low"), F.max(high).alias("high"))
    span = span.where("low IS NOT NULL").select(
        F.explode(F.sequence(F.date_sub("low", 1), F.date_add("high", 1))).alias("date_actual")
    )
    return _date_rows(span)


def dim_time(spark: SparkSession) -> DataFrame:
    """One row per second of the day; time_id is the second, time_actual its HH:mm:ss text."""
    second = F.col("id")
    return spark.range(86_400, numPartitions=1).select(
        second.cast("int").alias("time_id"),
        F.date_format(F.timestamp_seconds(second), "HH:mm:ss").alias("time_actual"),
    )


def _date_side(dates: DataFrame, key: str, name: str) -> DataFrame:
    # Years 1 to 9999 hold 3.7 million days, so a calendar of days is bounded by nature.
    return F.broadcast(dates.select(F.unix_date("date_actual").alias(key), F.col("date_id").alias(name)))


def _time_side(times: DataFrame, key: str, name: str) -> DataFrame:
    # 86,400 rows at the grain of dim_time.
    return F.broadcast(
        times.select(clock.clock_micros(F.col("time_actual")).alias(key), F.col("time_id").alias(name))
    )


def add_roles(
    df: DataFrame,
    roles: Mapping[str, str | Column],
    dates: DataFrame,
    times: DataFrame | None = None,
    zone: str = clock.UTC,
    truncate: bool = False,
) -> DataFrame:
    """For each role and its timestamp add <role>_date_local, _date_utc, _time_local and _time_utc.

    All joins are inner and exact: a NULL timestamp, a day outside `dates` or a time
    that is not in `times` (any sub-second, at second grain) drops the row. `truncate`
    cuts timestamps to whole seconds first. Without `times` only the dates are added.

    Local and UTC are the same clock when `zone` is UTC, so one join serves both there.
    Keys of `dates` and `times` have to be unique.
    """
    zones = {"utc": clock.UTC} if zone == clock.UTC else {"local": zone, "utc": clock.UTC}
    keys, lookups = [], []
    for role, source in roles.items():
        ts = F.col(source) if isinstance(source, str) else source
        ts = clock.whole_seconds(ts) if truncate else ts
        for label, where in zones.items():
            day_key, time_key = f"_{role}_day_{label}", f"_{role}_time_{label}"
            keys.append(clock.day_number(ts, where).alias(day_key))
            lookups.append((day_key, _date_side(dates, day_key, f"{role}_date_{label}")))
            if times is not None:
                keys.append(clock.micros_of_day(ts, where).alias(time_key))
                lookups.append((time_key, _time_side(times, time_key, f"{role}_time_{label}")))
    out = df.select("*", *keys)
    for key, side in lookups:
        out = out.join(side, key, "inner")
    if zone == clock.UTC:
        parts = ("date",) if times is None else ("date", "time")
        out = out.select(
            "*", *[F.col(f"{r}_{p}_utc").alias(f"{r}_{p}_local") for r in roles for p in parts]
        )
    return out.drop(*[key for key, _ in lookups])
