"""Parquet and JSON-lines files, read by glob.

A glob names the files themselves, so a sink log that a stream left in the directory can neither hide
files that a batch job wrote (H7) nor break the read (H9).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strandline.contracts import ENVELOPE


def glob_of(path: str, depth: int = 0, suffix: str = ".parquet") -> str:
    """The files ``depth`` directories below a location. A glob does not recurse."""
    return f"{path.rstrip('/')}/{'*/' * depth}*{suffix}"


def is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_files(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    depth: int = 0,
    missing_ok: bool = False,
    base_path: str | None = None,
) -> DataFrame:
    """Batch Parquet scan with a fixed schema.

    ``missing_ok`` gives an empty table for a location without files; by default that raises (H18).
    ``base_path`` fills the schema's partition columns from the directory names below it.
    """
    reader = spark.read.schema(schema)
    if base_path:
        reader = reader.option("basePath", base_path)
    try:
        return reader.parquet(glob_of(path, depth))
    except AnalysisException as error:
        if not (missing_ok and is_missing(error)):
            raise
        return spark.createDataFrame([], schema)


def stream_files(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    depth: int = 0,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
    max_file_age: str | None = None,
    archive_to: str | None = None,
) -> DataFrame:
    """Streaming Parquet scan with a fixed schema (S5, T10). A missing location starts empty.

    Each trigger lists the glob. Two options keep that list short: ``max_file_age``, as ``7d``, ignores files that
    are so much older than the newest; ``archive_to`` moves files there once their batch is committed, which is for
    locations that nobody else reads.

    Bound the first trigger over a large backlog with ``max_files_per_trigger`` or
    ``max_bytes_per_trigger``; Spark takes one of the two.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if max_file_age:
        reader = reader.option("maxFileAge", max_file_age)
    if archive_to:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_to)
    return reader.parquet(glob_of(path, depth))


def recent_days(as_of: datetime, days: int) -> list[str]:
    """The UTC day of ``as_of``, the one after it (for clocks that run ahead) and ``days`` before it, as ``yyyy-mm-dd``."""
    today = as_of.astimezone(timezone.utc).date()
    return [(today + timedelta(days=n)).isoformat() for n in range(-days, 2)]


def stream_days(
    spark: SparkSession, path: str, schema: str | StructType, days: Sequence[str], depth: int = 2, **options
) -> DataFrame:
    """Streaming scan of the ``day=`` directories of some days, for jobs that run to the end of their input and start again.

    Only those days are listed, whatever the history holds: give :func:`recent_days` with the lateness that rows may have. The
    checkpoint remembers the files it has read, so the days may move on from run to run; a row that comes to a day
    before the first one waits for a run that names it. Options as in :func:`stream_files`.
    """
    places = "{" + ",".join(days) + "}"
    return stream_files(spark, f"{path.rstrip('/')}/day={places}", schema, depth, **options)


def read_bronze(spark: SparkSession, path: str, schema: str = ENVELOPE, **options) -> DataFrame:
    """Batch scan of a bronze table (S4), options as in :func:`read_files`."""
    return read_files(spark, path, schema, **options)


def stream_bronze(spark: SparkSession, path: str, schema: str = ENVELOPE, **options) -> DataFrame:
    """Streaming scan of a bronze table (S5), options as in :func:`stream_files`."""
    return stream_files(spark, path, schema, **options)


def _landed(lines: DataFrame, topic: str) -> DataFrame:
    return lines.select(
        F.lit(topic).alias("topic"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
        F.col("value").alias("json_str"),
    )


def read_landed_json(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """JSON readings that lie as text, one per line, as envelope rows.

    The ingestion time of a line is the modification time of its file.
    """
    return _landed(spark.read.format("text").load(path), topic)


def stream_landed_json(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """As :func:`read_landed_json`, for files that keep arriving."""
    return _landed(spark.readStream.format("text").load(path), topic)


INVENTORY = "stage STRING, path STRING, modificationTime TIMESTAMP, length BIGINT"


def file_inventory(
    spark: SparkSession,
    locations: Sequence[tuple[str, str]],
    suffix: str = ".parquet",
    modified_after: str | None = None,
    days: Sequence[str] | None = None,
) -> DataFrame:
    """One row per file below each ``(stage, location)`` pair, at any depth.

    Only the listing is read, file contents are pruned. ``modified_after`` (UTC text) leaves older
    files out already at listing time, so a freshness check over a large table touches only what arrived
    lately. ``days`` lists the ``day=`` directories of some days only, whatever else a location holds. A location that
    does not exist has no rows.
    """
    below = "" if days is None else "/day={" + ",".join(days) + "}"
    found = []
    for stage, location in locations:
        reader = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", f"*{suffix}")
        )
        if modified_after:
            reader = reader.option("modifiedAfter", modified_after).option("timeZone", "UTC")
        try:
            files = reader.load(location.rstrip("/") + below)
        except AnalysisException as error:
            if not is_missing(error):
                raise
            continue
        found.append(files.select(F.lit(stage).alias("stage"), "path", "modificationTime", "length"))
    if not found:
        return spark.createDataFrame([], INVENTORY)
    first, *others = found
    for files in others:
        first = first.unionByName(files)
    return first
