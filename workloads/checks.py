"""Health queries. The as-of time is fixed, so that the results can be compared."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.contracts import CONDITIONS
from strandline.functions import instant
from strandline.operators import health
from strandline.operators import envelope
from strandline.operators.parse import to_silver
from strandline.plans.health import check_files
from strandline.session import scratch_dir
from strandline.sources import end_offsets, file_inventory
from workloads.messages import EVENTS_SCHEMA, conditions_bronze, events, logged, naive, props_messages
from workloads.registry import query

# "refund" is expected but has no messages.
TOPICS = ["click", "error", "purchase", "refund", "signup", "view"]
TOPICS_SQL = "(VALUES ('click'), ('error'), ('purchase'), ('refund'), ('signup'), ('view')) AS expected(topic)"
PRESENT = [t for t in TOPICS if t != "refund"]
PRESENT_SQL = "(VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) AS expected(topic)"

AS_OF = "2024-01-15T12:00:00Z"
AS_OF_SQL = "TIMESTAMP '2024-01-15 12:00:00'"
END = "2024-01-30T23:50:00Z"
END_SQL = "TIMESTAMP '2024-01-30 23:50:00'"
LABELS = {"click": "web", "view": "web", "error": "ops"}


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope(props_messages(events(spark, sf_dir)))


@query(
    f"""
    SELECT topic, n IS NOT NULL AS found, coalesce(n, 0) AS n_rows
    FROM {TOPICS_SQL} LEFT JOIN (SELECT event_type AS topic, count(*) AS n FROM events GROUP BY 1) USING (topic)
    """
)
def topic_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 A7"""
    return health.topic_presence(_log(spark, sf_dir), TOPICS)


@query(f"SELECT topic FROM {TOPICS_SQL} WHERE topic NOT IN (SELECT event_type FROM events)")
def topic_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1, as an anti join"""
    return health.missing_topics(_log(spark, sf_dir), TOPICS)


@query(
    """
    SELECT event_type AS topic, CASE event_type WHEN 'error' THEN 'ops' ELSE 'web' END AS label,
           ts AS "timestamp", props AS json_str
    FROM events WHERE event_type IN ('click', 'view', 'error')
    """
)
def topic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2"""
    return naive(health.labelled(_log(spark, sf_dir), "topic", LABELS))


@query(
    """
    SELECT event_type AS topic, count(*) AS total FROM events GROUP BY 1
    """
)
def topic_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End offsets of a log whose offsets count the messages of each partition add up to their number"""
    return health.topic_totals(end_offsets(logged(events(spark, sf_dir))))


def _activity_sql(as_of: str, marker: str | None = None) -> str:
    text = f" AND contains(props, '{marker}')" if marker else ""
    return f"""
        SELECT topic, coalesce(n, 0) AS n_recent, n IS NOT NULL AS ok
        FROM {TOPICS_SQL} LEFT JOIN (
            SELECT event_type AS topic, count(*) AS n FROM events
            WHERE ts >= {as_of} - INTERVAL 1800 SECOND AND ts <= {as_of}{text} GROUP BY 1) USING (topic)
    """


@query(_activity_sql(AS_OF_SQL))
def recent_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 A6 C3 F8 F9 F10"""
    return health.recent_activity(_log(spark, sf_dir), TOPICS, instant(AS_OF))


@query(_activity_sql(AS_OF_SQL, "1"))
def recent_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only rows whose text contains a marker"""
    return health.recent_activity(_log(spark, sf_dir), TOPICS, instant(AS_OF), marker="1")


def _fresh_sql(as_of: str) -> str:
    return f"""
        SELECT topic, latest, CAST(floor(epoch({as_of})) - floor(epoch(latest)) AS BIGINT) AS age_seconds,
               coalesce(latest >= {as_of} - INTERVAL 1800 SECOND, FALSE) AS ok
        FROM {TOPICS_SQL}
        LEFT JOIN (SELECT event_type AS topic, max(ts) AS latest FROM events WHERE ts <= {as_of} GROUP BY 1) USING (topic)
    """


@query(_fresh_sql(END_SQL))
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 A7 P14 C5 F13"""
    latest = health.bounded_latest(_log(spark, sf_dir), "topic", "timestamp", TOPICS, instant(END), 1800)
    return naive(health.freshness(latest, TOPICS, instant(END), group="topic"))


DAY = 86_400


def _parts(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    """The four stages: activity and offsets of the log, then the age of bronze and of a silver table made from it."""

    def fresh(table: DataFrame, group: str, expected: list[str], stage: str) -> DataFrame:
        latest = health.bounded_latest(table, group, "timestamp", expected, instant(END), DAY)
        return health.freshness_checks(health.freshness(latest, expected, instant(END), DAY, group), stage, group)

    def producers() -> DataFrame:
        return health.activity_checks(health.recent_activity(_log(spark, sf_dir), PRESENT, instant(END), DAY), DAY)

    def silver() -> DataFrame:
        # condition_main is the event type.
        table = to_silver(conditions_bronze(events(spark, sf_dir)), CONDITIONS)
        return fresh(table, "condition_main", PRESENT, "silver")

    return {
        "producers": producers,
        "kafka": lambda: health.topic_checks(logged(events(spark, sf_dir)), PRESENT),
        "bronze": lambda: fresh(_log(spark, sf_dir), "topic", TOPICS, "bronze"),
        "silver": silver,
    }


def _checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.run_stages(_parts(spark, sf_dir))


_AGE_SQL = f"""
    CASE WHEN latest IS NULL THEN 'nothing there'
         ELSE 'latest ' || strftime(latest, '%Y-%m-%dT%H:%M:%S.%f') || 'Z (' ||
              CAST(floor(epoch({END_SQL})) - floor(epoch(latest)) AS BIGINT) || ' s old)' END
"""

_CHECKS_SQL = f"""
    WITH seen AS (
        SELECT event_type AS topic, max(ts) FILTER (WHERE ts <= {END_SQL}) AS latest,
               count(*) FILTER (WHERE ts >= {END_SQL} - INTERVAL 86400 SECOND AND ts <= {END_SQL}) AS n_recent,
               count(*) AS total
        FROM events GROUP BY 1),
    checks AS (
        SELECT 'producers' AS stage, topic AS "check", coalesce(n_recent > 0, FALSE) AS ok,
               coalesce(n_recent, 0) || ' records in the last 86400 s' AS detail
        FROM {PRESENT_SQL} LEFT JOIN seen USING (topic)
        UNION ALL
        SELECT 'kafka', topic, coalesce(total > 0, FALSE),
               coalesce('end offsets sum to ' || total, 'no such topic')
        FROM {PRESENT_SQL} LEFT JOIN seen USING (topic)
        UNION ALL
        SELECT 'bronze', topic, coalesce(latest >= {END_SQL} - INTERVAL 86400 SECOND, FALSE), {_AGE_SQL}
        FROM {TOPICS_SQL} LEFT JOIN seen USING (topic)
        UNION ALL
        SELECT 'silver', topic, coalesce(latest >= {END_SQL} - INTERVAL 86400 SECOND, FALSE), {_AGE_SQL}
        FROM {PRESENT_SQL} LEFT JOIN seen USING (topic))
"""


@query(f'{_CHECKS_SQL} SELECT stage, "check", ok, detail FROM checks')
def stage_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check with what it found, as text"""
    return _checks(spark, sf_dir)


@query(
    f"""
    SELECT 'producers' AS stage, topic AS "check", coalesce(n > 0, FALSE) AS ok,
           coalesce(n, 0) || ' records in the last 1800 s' AS detail
    FROM {TOPICS_SQL} LEFT JOIN (
        SELECT event_type AS topic, count(*) AS n FROM events
        WHERE ts >= {AS_OF_SQL} - INTERVAL 1800 SECOND AND ts <= {AS_OF_SQL} GROUP BY 1) USING (topic)
    UNION ALL
    SELECT 'bronze', topic, FALSE, 'unreachable: PATH_NOT_FOUND' FROM {TOPICS_SQL}
    """
)
def source_unreachable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is not there fails its checks, and only those"""
    log = lambda path: envelope(props_messages(spark.read.schema(EVENTS_SCHEMA).parquet(path)))
    parts = [
        health.reachable(
            spark, stage, TOPICS,
            lambda path=path: health.activity_checks(health.recent_activity(log(path), TOPICS, instant(AS_OF)), 1800, stage="producers"),
        )
        for stage, path in (("producers", f"{sf_dir}/events.parquet"), ("bronze", f"{sf_dir}/no_such_table.parquet"))
    ]
    return health.all_checks(*parts)


@query(
    f"""
    {_CHECKS_SQL},
    stages AS (
        SELECT ord, stage, coalesce(bool_and(ok), FALSE) AS ok, count(*) FILTER (WHERE NOT ok) AS n_failed
        FROM (VALUES (0, 'producers'), (1, 'kafka'), (2, 'bronze'), (3, 'silver')) AS flow(ord, stage)
        LEFT JOIN checks USING (stage) GROUP BY ord, stage)
    SELECT CAST(ord AS INTEGER) AS ord, stage,
           CASE WHEN ord > (SELECT min(ord) FROM stages WHERE NOT ok) THEN 'BLOCKED'
                WHEN ok THEN 'OK' ELSE 'FAIL' END AS status,
           n_failed
    FROM stages
    """
)
def stage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topic is missing from bronze, so silver is blocked"""
    return health.stage_report(_checks(spark, sf_dir))


@query(f'{_CHECKS_SQL} SELECT stage, "check" FROM checks WHERE NOT ok')
def stage_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P16"""
    return health.failures(_checks(spark, sf_dir)).select("stage", "check")


@query(f"{_CHECKS_SQL} SELECT count(*) FILTER (WHERE NOT ok) AS n_failed, bool_and(ok) AS healthy FROM checks")
def stage_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 A5"""
    return health.verdict(_checks(spark, sf_dir))


@query(f'{_CHECKS_SQL} SELECT "check", ok FROM checks WHERE stage = \'kafka\'')
def stage_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stage alone"""
    return health.run_stages(_parts(spark, sf_dir), "kafka").select("check", "ok")


@query(f"{_CHECKS_SQL} SELECT stage, \"check\", stage <> 'silver' AND ok AS ok FROM checks")
def stage_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of a stage whose precondition fails are not believed"""
    checks = health.guarded(_checks(spark, sf_dir), F.col("stage") != "silver", "writer is not running")
    return checks.select("stage", "check", "ok")


# ------------------------------------------------------------------ files


def _event_files(spark: SparkSession, sf_dir: str) -> str:
    """Events in a directory for each type, with one file that is no Parquet."""
    path = f"{scratch_dir(spark, 'files')}/events"
    rows = events(spark, sf_dir)
    rows.hint("rebalance", F.col("event_type")).write.partitionBy("event_type").parquet(path)
    rows.groupBy("event_type").count().coalesce(1).write.mode("append").csv(path)
    return path


@query("SELECT event_type, '.parquet' AS suffix, count(*) AS n_rows, TRUE AS all_have_bytes FROM events GROUP BY 1")
def file_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files that the listing finds, with the rows that are in them"""
    path = _event_files(spark, sf_dir)
    plain = lambda column: F.regexp_replace(column, "^file:/+", "/")
    listed = file_inventory(spark, [("events", path)]).select(plain("path").alias("path"), "length")
    held = spark.read.parquet(f"{path}/*/*.parquet").groupBy(plain("_metadata.file_path").alias("path")).count()
    found = listed.join(held, "path", "left").withColumns(
        {"event_type": F.regexp_extract("path", "event_type=([^/]*)/", 1), "suffix": F.regexp_extract("path", r"\.[a-z]+$", 0)}
    )
    return found.groupBy("event_type", "suffix").agg(
        F.sum("count").alias("n_rows"), F.bool_and(F.col("length") > 0).alias("all_have_bytes")
    )


@query(
    """
    SELECT event_type AS stage, TRUE AS has_files, TRUE AS ok FROM events GROUP BY 1
    UNION ALL SELECT 'refund', FALSE, FALSE
    """
)
def file_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that were written just now, and one that does not exist"""
    path = _event_files(spark, sf_dir)
    as_of = datetime.now(timezone.utc) + timedelta(seconds=5)
    fresh = check_files(spark, [(t, f"{path}/event_type={t}") for t in TOPICS], as_of)
    return fresh.select("stage", F.col("latest").isNotNull().alias("has_files"), "ok")
