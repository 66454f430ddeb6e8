"""Dates, times of day, zones and durations as JVM-side column expressions.

Timestamps are instants. A timestamp without zone is read as UTC, which is what the
cast below does under the session zone of `skyledger.session`.
"""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

UTC = "UTC"
MICROS_PER_DAY = 86_400_000_000


def in_zone(ts: Column, zone: str = UTC) -> Column:
    """The wall clock of `zone` at the instant `ts`."""
    ts = ts.cast("timestamp")
    return ts if zone == UTC else F.from_utc_timestamp(ts, zone)


def local_date(ts: Column, zone: str = UTC) -> Column:
    return F.to_date(in_zone(ts, zone))


def day_number(ts: Column, zone: str = UTC) -> Column:
    """Days since 1970-01-01 as an int, so that a join on it hashes a primitive."""
    return F.unix_date(local_date(ts, zone))


def micros_of_day(ts: Column, zone: str = UTC) -> Column:
    """Exact time of day as a bigint, sub-seconds included."""
    return F.pmod(F.unix_micros(in_zone(ts, zone)), F.lit(MICROS_PER_DAY))


def clock_text(ts: Column, zone: str = UTC) -> Column:
    """Exact time of day as text, HH:mm:ss.SSSSSS."""
    return F.date_format(in_zone(ts, zone), "HH:mm:ss.SSSSSS")


def clock_micros(text: Column) -> Column:
    """Inverse of `micros_of_day` for HH:mm:ss[.SSSSSS] text."""
    return F.unix_micros(F.to_timestamp(F.concat(F.lit("1970-01-01 "), text, F.lit("Z"))))


def whole_seconds(ts: Column) -> Column:
    return F.date_trunc("second", ts)


def elapsed(start: Column, end: Column) -> Column:
    """end - start as a day-time interval; negative when end is earlier."""
    return end - start


def elapsed_seconds(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def parse_day(ds: str | dt.date) -> dt.date:
    if isinstance(ds, dt.datetime):
        return ds.date()
    return ds if isinstance(ds, dt.date) else dt.date.fromisoformat(ds)


def data_day(ds: str | dt.date) -> dt.date:
    """The day a daily run looks at: the one before its own date."""
    return parse_day(ds) - dt.timedelta(days=1)


def on_day(col: Column, day: dt.date, data_type: str) -> Column:
    """True for timestamps of `day`, as a half-open range that sources can filter on."""
    start = F.lit(day.isoformat()).cast(data_type)
    end = F.lit((day + dt.timedelta(days=1)).isoformat()).cast(data_type)
    return (col >= start) & (col < end)
