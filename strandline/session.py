"""Session defaults and the scratch location shared by every executor."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    # Cutoff strings and epoch columns mean the same instant on every machine.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # AQE sizes shuffle reads by bytes, so the initial count only has to be high enough.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Call-site capture per column expression costs more than building a wide projection.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # A feed that holds most of a log meets its sessions as a row for each task.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # State that outgrows executor memory stays on disk.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "strandline", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the library's defaults.

    ``conf`` keys may use ``__`` for the dots, as in ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{key.replace("__", "."): value for key, value in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Set the zone on a session that somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh location that all executors can reach, below the session's checkpoint folder.

    That is ``spark.checkpoint.dir``, or what ``SparkContext.setCheckpointDir`` was given. Without either it raises:
    a folder of the driver's own would work on one machine and lose files on a cluster.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{shared.rstrip('/')}/strandline/{label}-{uuid.uuid4().hex}"
