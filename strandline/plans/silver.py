"""Reading silver: the batch half and the stream half as one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strandline.contracts import ENVELOPE, Feed
from strandline.operators.handoff import union_parts
from strandline.operators.parse import to_silver
from strandline.sources.files import read_files
from strandline.streaming.sinks import read_parts


def silver_schema(spark: SparkSession, feed: Feed, keep: Sequence[str] = ()) -> StructType:
    """The columns of silver, with those of the log position that it keeps."""
    return to_silver(spark.createDataFrame([], f"{ENVELOPE}, partition INT, offset BIGINT"), feed, keep).schema


def silver_view(
    spark: SparkSession,
    feed: Feed,
    backfill_path: str,
    parts_path: str,
    missing_ok: bool = False,
    by_day: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Both halves of silver (U1, H7, H9). With ``missing_ok`` a half that has no files yet is empty.

    ``by_day`` and ``keep`` as they were given to the backfill. For jobs with a quarantine, give the ``part=silver``
    directories.
    """
    schema = silver_schema(spark, feed, keep)
    return union_parts(
        read_files(spark, backfill_path, schema, depth=int(by_day), missing_ok=missing_ok),
        read_parts(spark, parts_path, schema, missing_ok=missing_ok),
    )
