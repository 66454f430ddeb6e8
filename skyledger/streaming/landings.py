"""Load dated landings as a stream, so that no day is missed and none is read twice."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from skyledger.operators.joins import latest_per_key
from skyledger.plans.staging import upsert_table
from skyledger.schemas import Table
from skyledger.sources.landing import daily_root, read_csv_files, stream_landed_files, with_types
from skyledger.sources.store import Store


def stream_daily_landings(
    store: Store, table: Table, landing: str, checkpoint: str, run_ts: dt.datetime, rules: bool = True
) -> StreamingQuery:
    """Upsert the landed days that the checkpoint has not seen, then stop.

    The stream is one of files; those of a batch are read by name, whatever the order of their columns.
    Several days may come in one batch; the latest day of a key wins. A day that lands after a later one
    changes no row that is newer by `updated_at`. Running a batch again after a failure upserts the same
    rows again, which changes nothing.
    """

    def load(batch: DataFrame, _batch_id: int) -> None:
        files = [r["path"] for r in batch.collect()]  # the names of one batch's files
        if not files:
            return
        text = read_csv_files(store.spark, sorted(files), day=True)
        typed = with_types(text, table.schema, table, keep=("dt",))
        newest = latest_per_key(typed, table.key, "dt").drop("dt")
        upsert_table(store, table, newest, run_ts, rules=rules, keep_newer=True)

    return (
        stream_landed_files(store.spark, daily_root(landing, table.name))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
