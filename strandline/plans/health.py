"""Health of a running setup: its log, its topics and its file tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.contracts import ACTIVITY_WINDOW_SECONDS, FRESHNESS_SECONDS, STAGES
from strandline.functions import instant
from strandline.operators.health import (
    RESULT,
    activity_checks,
    all_checks,
    freshness,
    freshness_checks,
    guarded,
    latest_by,
    listed,
    offset_checks,
    reachable,
    recent_activity,
    topic_checks,
)
from strandline.sources.files import file_inventory, recent_days


def check_files(
    spark: SparkSession,
    locations: Sequence[tuple[str, str]],
    as_of: datetime,
    limit_seconds: int = FRESHNESS_SECONDS,
    look_back_days: int | None = None,
) -> DataFrame:
    """Age of the newest Parquet file per location.

    A healthy table has a file younger than the limit, and those alone are listed first. Only locations
    without one are listed in full, to say how old they are.

    For tables in ``day=`` directories, as the parts sink writes them, give ``look_back_days``: then the directories of the days within
    the limit are listed, and for a location without a file there those of so many days, but never the whole history. What
    has no file in that time is not there.
    """
    names = [name for name, _ in locations]
    # Listing compares whole seconds, so take one more; the exact test is in freshness().
    since = as_of.astimezone(timezone.utc) - timedelta(seconds=limit_seconds + 1)
    by_day = lambda n: None if look_back_days is None else recent_days(as_of, n)
    near = by_day(1 + limit_seconds // 86_400)
    recent = _newest(file_inventory(spark, locations, modified_after=since.strftime("%Y-%m-%dT%H:%M:%S"), days=near))
    # One row per location.
    seen = [tuple(row) for row in recent.collect()]
    newest = listed(spark, "stage STRING, micros BIGINT", seen)
    stale = [pair for pair in locations if pair[0] not in dict(seen)]
    if stale:
        newest = newest.unionByName(_newest(file_inventory(spark, stale, days=by_day(look_back_days))))
    latest = newest.select("stage", F.timestamp_micros("micros").alias("latest"))
    return freshness(latest, names, instant(as_of), limit_seconds)


def _newest(files: DataFrame) -> DataFrame:
    return latest_by(files, "stage", "modificationTime").select("stage", F.unix_micros("latest").alias("micros"))


def setup_checks(
    spark: SparkSession,
    as_of: datetime,
    topics: Sequence[str],
    log: Callable[[], DataFrame],
    messages: Callable[[], DataFrame],
    tables: Mapping[str, Sequence[tuple[str, str]]],
    running: Mapping[str, bool] | None = None,
    stage: str | None = None,
    activity_seconds: int = ACTIVITY_WINDOW_SECONDS,
    freshness_seconds: int = FRESHNESS_SECONDS,
    offsets: Callable[[], DataFrame] | None = None,
) -> DataFrame:
    """All checks in flow order, or those of one stage.

    * producers: each topic has a row in ``log`` within ``activity_seconds``.
    * kafka: each topic has end offsets that sum to more than zero. ``offsets`` gives them as a query's progress or
      the broker reports them (``sources.reported_offsets``); without it all retained ``messages`` are read.
    * bronze, silver: each ``(name, location)`` of ``tables[stage]`` has a file younger than
      ``freshness_seconds``. ``running[stage]`` tells whether its writer runs; if not, the files are not
      looked at.

    A source that can not be read fails its rows. Feed the result to ``operators.health.stage_report`` for
    the state per stage, and to ``verdict`` for the whole.
    """
    up = running or {}

    def table_checks(name: str) -> DataFrame:
        if not up.get(name, True):
            rows = [(name, table, False, "") for table, _ in tables[name]]
            return guarded(listed(spark, RESULT, rows), False, "writer is not running")
        return freshness_checks(check_files(spark, tables[name], as_of, freshness_seconds), name)

    def producers() -> DataFrame:
        recent = recent_activity(log(), topics, instant(as_of), activity_seconds)
        return activity_checks(recent, activity_seconds)

    checks = {
        "producers": (topics, producers),
        "kafka": (
            topics,
            lambda: offset_checks(offsets(), topics) if offsets else topic_checks(messages(), topics),
        ),
        "bronze": ([name for name, _ in tables["bronze"]], lambda: table_checks("bronze")),
        "silver": ([name for name, _ in tables["silver"]], lambda: table_checks("silver")),
    }
    chosen = STAGES if stage is None else (stage,)
    return all_checks(*(reachable(spark, name, *checks[name]) for name in chosen))
