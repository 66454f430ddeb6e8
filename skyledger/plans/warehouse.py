"""Daily warehouse run: dimensions, then facts, each kept as a type-2 history."""

import dataclasses
import datetime as dt
import math
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions import clock
from skyledger.operators.calendar import dim_date, dim_date_over, dim_time
from skyledger.operators.snapshot import snapshot_changes
from skyledger.plans import dimensions, facts
from skyledger.plans.staging import staging_frames
from skyledger.schemas import TABLES
from skyledger.sources.store import Store, bucket_number


@dataclasses.dataclass(frozen=True)
class Target:
    """A history table: its key, and the query for it. All other columns are compared.

    `dealt_by` is a column of the key by which rows, and those of the staging tables that have it, can be dealt
    into slices that never meet.
    """

    key: tuple[str, ...]
    build: Callable[..., DataFrame]
    dealt_by: str | None = None


def _dimension(build):
    return lambda stg, dims, **_: build(stg)


TARGETS: Mapping[str, Target] = {
    "dim_aircrafts": Target(("aircraft_id",), _dimension(dimensions.dim_aircrafts)),
    "dim_airport": Target(("airport_id",), _dimension(dimensions.dim_airport)),
    "dim_passenger": Target(("passenger_id",), _dimension(dimensions.dim_passenger)),
    "dim_seat": Target(
        ("seat_id",), lambda stg, dims, versions, **_: dimensions.dim_seat(stg, dims, versions)
    ),
    "fct_seat_occupied_daily": Target(
        ("date_flight", "flight_nk"),
        lambda stg, dims, zone, versions, **_: facts.fct_seat_occupied_daily(stg, dims, zone, versions),
    ),
    "fct_flight_activity": Target(
        ("flight_nk",),
        lambda stg, dims, zone, versions, truncate, **_: facts.fct_flight_activity(
            stg, dims, zone, versions, truncate
        ),
    ),
    "fct_boarding_pass": Target(
        ("ticket_no", "flight_id", "boarding_no"),
        lambda stg, dims, zone, versions, truncate, **_: facts.fct_boarding_pass(
            stg, dims, zone, versions, truncate
        ),
        "ticket_no",
    ),
    "fct_booking_ticket": Target(("book_nk", "ticket_no", "flight_nk"), facts.fct_booking_ticket, "ticket_no"),
}
DIMENSIONS = tuple(name for name in TARGETS if name.startswith("dim_"))
# Tables of a wave do not read each other; a wave reads the ones before it. The two facts that shuffle most have
# a wave each, so that the disk never holds the shuffles of both.
WAVES = (
    ("dim_aircrafts", "dim_airport", "dim_passenger"),
    ("dim_seat", "fct_seat_occupied_daily", "fct_flight_activity", "fct_boarding_pass"),
    ("fct_booking_ticket",),
)
#: Most slices of a fact. Each reads the tables that are not dealt anew, so their number does not grow with the data.
SLICES = 2


def write_calendar(
    store: Store, stg: Mapping[str, DataFrame], zone: str = clock.UTC, span: tuple[dt.date, dt.date] | None = None
) -> None:
    """Store dim_date for `span`, or for the days the staging data cover, and dim_time once."""
    if span:
        dates = dim_date(store.spark, *span)
    else:
        flown = dim_date_over(stg["flights"], *facts.PLANNED, *facts.FLOWN, zone=zone)
        dates = flown.union(dim_date_over(stg["bookings"], "book_date", zone=zone)).distinct()
    store.write("final.dim_date", dates.coalesce(1))
    if not store.exists("final.dim_time"):
        store.write("final.dim_time", dim_time(store.spark))


def _slices(store: Store, column: str | None) -> list[Callable[[DataFrame], DataFrame]]:
    """Filters that deal the rows of frames with `column` into slices; one that takes all if the staging tables are small."""
    names = [f"stg.{t.name}" for t in TABLES.values() if column in t.schema.names]
    count = min(SLICES, math.ceil(sum(store.live_bytes(n) for n in names if store.exists(n)) / store.bucket_bytes))
    if count < 2:
        return [lambda df: df]
    part = lambda i: lambda df: df.where(bucket_number([F.col(column)], count) == i) if column in df.columns else df
    return [part(i) for i in range(count)]


def snapshot_table(
    store: Store, name: str, stg: Mapping[str, DataFrame], dims: Mapping[str, DataFrame], options: Mapping, run_ts: dt.datetime
) -> None:
    """Extend the history final.<name> by what one run changes, slice by slice.

    The shuffles of a slice go when it is written, so the disk holds those of one slice and not of the table.
    """
    table, target = f"final.{name}", TARGETS[name]
    current = store.read_open(table) if store.exists(table) else None

    def changes(part: Callable[[DataFrame], DataFrame]) -> DataFrame:
        new = target.build({n: part(df) for n, df in stg.items()}, dims, **options)
        return snapshot_changes(None if current is None else part(current), new, target.key, run_ts)

    store.append_history(table, *map(changes, _slices(store, target.dealt_by)))


def run_warehouse(
    store: Store,
    run_ts: dt.datetime,
    zone: str = clock.UTC,
    versions: str = "current",
    truncate: bool = False,
    passenger_join: str = "surrogate",
    span: tuple[dt.date, dt.date] | None = None,
    names: tuple[str, ...] = tuple(TARGETS),
) -> None:
    """Snapshot the named tables: first the dimensions that others refer to, then the rest.

    The jobs of a wave overlap, so that the tail of one table does not idle the cluster.
    """
    stg = staging_frames(store)
    write_calendar(store, stg, zone, span)
    # Current versions are read without the closed ones.
    read = store.read_open if versions == "current" else store.read_history
    options = {"zone": zone, "versions": versions, "truncate": truncate, "passenger_join": passenger_join}
    for wave in WAVES:
        chosen = [name for name in wave if name in names]
        if not chosen:
            continue
        dims = {d: store.read(f"final.{d}") for d in ("dim_date", "dim_time")}
        dims.update({d: read(f"final.{d}") for d in DIMENSIONS if store.exists(f"final.{d}")})

        def snapshot(name: str) -> None:
            snapshot_table(store, name, stg, dims, options, run_ts)

        with ThreadPoolExecutor(max_workers=len(chosen)) as pool:
            list(pool.map(snapshot, chosen))
