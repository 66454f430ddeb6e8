"""Session settings the library is written for, and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Instants render and truncate in UTC; other zones are passed as arguments.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot join key even where that costs one more exchange further up.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A side already partitioned by ticket_no serves a (ticket_no, flight_id) join.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # jsonb keeps the last of two equal keys instead of failing.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Ids are hexadecimal digests, which only an entropy coder makes smaller.
    "spark.sql.parquet.compression.codec": "zstd",
    # The shuffles of a write or a count go when it is done, not when the driver next collects garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

_local_scratch = []


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "skyledger", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only a local master may fall back to a temporary folder of this machine; it is
    removed when Python exits.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if not _local_scratch:
        _local_scratch.append(tempfile.TemporaryDirectory(prefix="run-"))
    return _local_scratch[0].name


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the scratch folder, removed with its content when the JVM ends."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark).rstrip('/')}/run-{uuid.uuid4().hex}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    fs.deleteOnExit(folder)
    return f"{folder.toString()}/{name}"
