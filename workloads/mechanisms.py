"""Queries over what jobs leave behind: offsets, progress, drift, a graph of stages, silences, key sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.contracts import CONDITIONS, ENVELOPE
from strandline.functions import instant
from strandline.operators import after, envelope, health, up_to
from strandline.operators import graph as graphs
from strandline.operators import outages
from strandline.operators.drift import schema_drift as drift_report
from strandline.operators.intervals import offset_gaps as gaps_of
from strandline.operators.intervals import offset_ranges
from strandline.operators.parse import LOG_KEY, to_silver
from strandline.plans.backfill import backfill
from strandline.plans.incremental import incremental
from strandline.plans.ingest import ingest
from strandline.plans.silver import silver_schema
from strandline.session import scratch_dir
from strandline.sinks import batch_overwrite
from strandline.sources import read_files, stream_files
from strandline.streaming import (
    ProgressTable,
    first_within_watermark_salted,
    read_parts,
    read_progress,
    stream_parts,
)
from strandline.streaming import consumer_lag as lag_of
from workloads import sql
from workloads.checks import AS_OF, AS_OF_SQL, DAY, END, END_SQL, TOPICS, TOPICS_SQL
from workloads.messages import (
    conditions_bronze,
    cut_short,
    events,
    events_stream,
    files_for,
    landed,
    naive,
    props_messages,
    replayed,
)
from workloads.registry import query
from workloads.streams import NOW, finish

# ------------------------------------------------------------------ places of the log

_PLACED = """
    SELECT DISTINCT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS place FROM events
"""


@query(
    f"""
    WITH placed AS ({_PLACED}),
    pairs AS (
        SELECT topic, "partition", lag(place) OVER (PARTITION BY topic, "partition" ORDER BY place) + 1 AS first, place - 1 AS last
        FROM placed)
    SELECT topic, "partition", first, last, last - first + 1 AS missing FROM pairs WHERE first <= last
    """
)
def offset_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets that are not there, between those that are; every message came three times"""
    return gaps_of(offset_ranges(replayed(props_messages(events(spark, sf_dir)))))


@query(
    """
    SELECT CASE WHEN event_id % 10 < 6 THEN 'backfill' ELSE 'stream' END AS part, event_type AS topic,
           CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset", value + 273.15e0 AS temp
    FROM events
    """
)
def handoff_by_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history has holes all over; the stream takes what lies in them and nothing else"""
    base = scratch_dir(spark, "intervals")
    keep = ["partition", "offset"]
    history = conditions_bronze(events(spark, sf_dir).filter("event_id % 10 < 6"), keep)
    backfill(history, CONDITIONS, f"{base}/backfill", keys=LOG_KEY, keep=LOG_KEY)
    schema = silver_schema(spark, CONDITIONS, LOG_KEY)
    loaded = read_files(spark, f"{base}/backfill", schema)
    offset_ranges(loaded).write.parquet(f"{base}/ranges")
    finish(
        incremental(
            conditions_bronze(events_stream(spark, sf_dir), keep), CONDITIONS, f"{base}/stream", f"{base}/checkpoint",
            every=NOW, keep=LOG_KEY, ranges=spark.read.parquet(f"{base}/ranges"),
        )
    )
    halves = {"backfill": loaded, "stream": read_parts(spark, f"{base}/stream", schema)}
    first, second = (half.select(F.lit(name).alias("part"), *LOG_KEY, "temp") for name, half in halves.items())
    return first.unionByName(second)


# ------------------------------------------------------------------ progress


@query(
    """
    SELECT 'bronze' AS name, 4 AS batches, count(*) AS rows_in, 0 AS late_rows, 3 AS last_batch, CAST(NULL AS BIGINT) AS lag
    FROM events
    """
)
def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a query told of itself while it read the files of four micro-batches"""
    base = scratch_dir(spark, "progress")
    bronze = envelope(props_messages(events(spark, sf_dir)))
    files = files_for(spark, sf_dir, 4)
    landed(bronze, f"{base}/landed", 4 * files)
    source = stream_files(spark, f"{base}/landed", ENVELOPE, max_files_per_trigger=files)
    with ProgressTable(spark, f"{base}/progress"):
        finish(ingest(source, f"{base}/rows", f"{base}/checkpoint", NOW, name="bronze"))
    return lag_of(read_progress(spark, f"{base}/progress").where("name = 'bronze'")).drop("last_at")


@query(f"SELECT 'dedup' AS name, count(*) FILTER (WHERE ts <= {sql.CUTOFF_SQL}) AS late_rows FROM events")
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later half of the rows comes first, in two batches, so the rest is behind the watermark; it is dropped, and counted"""
    base = scratch_dir(spark, "late")
    bronze = envelope(props_messages(events(spark, sf_dir)), keep=["offset"])
    recent, files = after(bronze, sql.CUTOFF), files_for(spark, sf_dir, 2)
    for number, rows in enumerate((recent.filter("offset % 2 = 0"), recent.filter("offset % 2 = 1"), up_to(bronze, sql.CUTOFF))):
        landed(rows, f"{base}/landed/{number}", files)
    source = stream_files(spark, f"{base}/landed", bronze.schema, depth=1, max_files_per_trigger=files)
    unique = first_within_watermark_salted(source, ["topic", "offset"], "1 hour")
    with ProgressTable(spark, f"{base}/progress"):
        finish(stream_parts(unique, f"{base}/rows", f"{base}/checkpoint", NOW, name="dedup"))
    return lag_of(read_progress(spark, f"{base}/progress").where("name = 'dedup'")).select("name", "late_rows")


# ------------------------------------------------------------------ drift


@query(
    """
    WITH days AS (
        SELECT event_type AS topic, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT topic, day, '$' AS path, 'retyped' AS verdict, 'MALFORMED' AS kind, n, n AS "of" FROM days WHERE topic = 'click'
    UNION ALL SELECT topic, day, '$.cod', 'retyped', 'STRING', n, n FROM days WHERE topic = 'signup'
    UNION ALL SELECT topic, day, '$.wind.chill', 'unknown', 'DOUBLE', n, n FROM days WHERE topic = 'view'
    UNION ALL SELECT topic, day, '$.rain', 'missing', NULL, n, n FROM days WHERE topic NOT IN ('error', 'click')
    """
)
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topic has a field more, one a field of another type, one is cut short, and most lack an object"""
    bronze = cut_short(conditions_bronze(events(spark, sf_dir), text_code_for="signup"), "click")
    more = F.replace(F.col("json_str"), F.lit('"wind":{'), F.lit('"wind":{"chill":-1.5,'))
    bronze = bronze.withColumn("json_str", F.when(F.col("topic") == "view", more).otherwise(F.col("json_str")))
    return drift_report(bronze, CONDITIONS)


# ------------------------------------------------------------------ stages as a graph

NEEDS = {
    "producers": (),
    "kafka": ("producers",),
    "bronze": ("kafka",),
    "silver": ("bronze",),
    "archive": ("kafka",),
    "report": ("silver", "archive"),
}


@query(
    f"""
    WITH RECURSIVE edges(stage, needed) AS (
        VALUES ('kafka', 'producers'), ('bronze', 'kafka'), ('silver', 'bronze'), ('archive', 'kafka'), ('report', 'silver'),
               ('report', 'archive')),
    reach(stage, needed) AS (
        SELECT stage, needed FROM edges UNION SELECT r.stage, e.needed FROM reach r JOIN edges e ON r.needed = e.stage),
    feeds AS (
        SELECT event_type AS feed, max(ts) FILTER (WHERE ts <= {END_SQL}) >= {END_SQL} - INTERVAL 86400 SECOND AS recent
        FROM events WHERE event_type IN ('click', 'view') GROUP BY 1),
    state AS (
        SELECT feed, stage, CASE WHEN stage IN ('bronze', 'silver') THEN feed <> 'view' AND recent
                                 WHEN stage = 'producers' THEN recent ELSE TRUE END AS ok
        FROM feeds, (VALUES ('producers'), ('kafka'), ('bronze'), ('silver'), ('archive'), ('report')) AS s(stage)),
    blocked AS (
        SELECT b.feed, r.stage, string_agg(r.needed, ',' ORDER BY r.needed) AS blocked_by
        FROM reach r JOIN state b ON b.stage = r.needed AND NOT b.ok GROUP BY 1, 2)
    SELECT feed, stage, CASE WHEN blocked_by IS NOT NULL THEN 'BLOCKED' WHEN ok THEN 'OK' ELSE 'FAIL' END AS status,
           CASE WHEN ok THEN 0 ELSE 1 END AS n_failed, blocked_by
    FROM state LEFT JOIN blocked USING (feed, stage)
    """
)
def stage_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feeds, one of which never reached bronze; what needs only its topic goes on"""
    feeds, log = ["click", "view"], envelope(props_messages(events(spark, sf_dir)))
    bronze = log.filter("topic <> 'view'")

    def fresh(table: DataFrame, group: str, stage: str) -> DataFrame:
        latest = health.bounded_latest(table, group, "timestamp", feeds, instant(END), DAY)
        return health.freshness_checks(health.freshness(latest, feeds, instant(END), DAY, group), stage, group)

    # One look at the topics stands for all stages that need no more than them.
    stages = F.explode(F.array(*map(F.lit, ("kafka", "archive", "report")))).alias("stage")
    found = health.topic_presence(log, feeds)
    present = found.select(stages, F.col("topic").alias("check"), F.col("found").alias("ok"), F.lit("").alias("detail"))

    # Silver is a table in files: its messages are made and parsed once, and not in every step of the search for a silent feed.
    made = to_silver(conditions_bronze(events(spark, sf_dir).filter("event_type <> 'view'")), CONDITIONS)
    path = f"{scratch_dir(spark, 'graph')}/silver"
    batch_overwrite(made.select("timestamp", "condition_main"), path)
    silver = read_files(spark, path, "timestamp TIMESTAMP, condition_main STRING", missing_ok=True)
    checks = health.all_checks(
        health.activity_checks(health.recent_activity(log, feeds, instant(END), DAY), DAY),
        present,
        fresh(bronze, "topic", "bronze"),
        fresh(silver, "condition_main", "silver"),
    )
    return graphs.stage_graph(checks, feeds, NEEDS)


# ------------------------------------------------------------------ silences

_LIMIT = 7_200
_OUTAGES = f"""
    WITH log AS (SELECT event_type AS topic, ts FROM events WHERE ts <= {END_SQL}),
    ends AS (
        SELECT topic, lag(ts) OVER (PARTITION BY topic ORDER BY ts) AS silent_from, ts AS silent_to FROM log
        UNION ALL SELECT topic, max(ts), {END_SQL} FROM log GROUP BY topic)
    SELECT topic, silent_from, silent_to, (epoch_us(silent_to) - epoch_us(silent_from)) / 1000000 AS seconds
    FROM ends WHERE epoch_us(silent_to) - epoch_us(silent_from) >= {_LIMIT}000000
    UNION ALL
    SELECT topic, NULL, {END_SQL}, NULL FROM {TOPICS_SQL} WHERE topic NOT IN (SELECT topic FROM log)
"""


@query(_OUTAGES)
def feed_outages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stretch of two hours or more without a record, and a feed that has none"""
    log = envelope(props_messages(events(spark, sf_dir)))
    return naive(outages.feed_outages(log, _LIMIT, as_of=instant(END), expected=TOPICS))


@query(_OUTAGES)
def feed_outages_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from sessions that a stream keeps, its files in no order of time"""
    base = scratch_dir(spark, "sessions")
    files = files_for(spark, sf_dir, 3)
    events(spark, sf_dir).repartition(3 * files, F.xxhash64("event_id")).write.parquet(f"{base}/landed")
    rows = stream_files(spark, f"{base}/landed", events(spark, sf_dir).schema, max_files_per_trigger=files)
    finish(outages.stream_sessions(envelope(props_messages(rows)), f"{base}/sessions", f"{base}/checkpoint", _LIMIT, NOW))
    sessions = outages.read_sessions(spark, f"{base}/sessions")
    return naive(outages.silences(sessions, _LIMIT, as_of=instant(END), expected=TOPICS))


@query(
    f"""
    SELECT 'bronze' AS stage, topic AS "check", n IS NULL AS ok,
           CASE WHEN n IS NULL THEN 'no row is later than now' ELSE n || ' rows are later than now' END AS found
    FROM {TOPICS_SQL}
    LEFT JOIN (SELECT event_type AS topic, count(*) AS n FROM events WHERE ts > {AS_OF_SQL} GROUP BY 1) USING (topic)
    """
)
def future_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that bear a later time than the one at which they are looked at"""
    log = envelope(props_messages(events(spark, sf_dir)))
    checks = health.future_checks(log, "topic", "timestamp", TOPICS, instant(AS_OF), "bronze")
    return checks.select("stage", "check", "ok", F.split("detail", ", ")[0].alias("found"))


# ------------------------------------------------------------------ keys without a time


@query(sql.select(sql.ENVELOPE | {"key": "sha256(CAST(event_id AS VARCHAR))"}))
def stream_key_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is a digest that says nothing of the time; two batches, then two with copies of the first one's rows, a year late"""
    base = scratch_dir(spark, "sketch")
    key = F.sha2(F.col("offset").cast("string"), 256).alias("key")
    bronze = envelope(props_messages(events(spark, sf_dir)), keep=["offset"]).select("topic", "timestamp", "json_str", key)
    files = files_for(spark, sf_dir, 2)
    landed(bronze, f"{base}/landed/0", 2 * files)
    again = spark.read.parquet(f"{base}/landed/0").filter(F.col("timestamp") < instant("2024-01-04T00:00:00Z"))
    again = again.withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(days=F.lit(365)))
    landed(again, f"{base}/landed/1", 2 * files)
    source = stream_files(spark, f"{base}/landed", bronze.schema, depth=1, max_files_per_trigger=files)
    finish(
        stream_parts(
            source, f"{base}/rows", f"{base}/checkpoint", NOW, new_keys=["key"], time_bounded=False, sketch=f"{base}/sketches"
        )
    )
    return naive(read_parts(spark, f"{base}/rows", bronze.schema))


@query(sql.select(sql.ENVELOPE | {"offset": "event_id"}))
def dedup_watermark_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stateful dedup in two steps, so that the copies of a hot key are many tasks' work"""
    base = scratch_dir(spark, "salted")
    stream = replayed(envelope(props_messages(events_stream(spark, sf_dir)), keep=["offset"]))
    unique = first_within_watermark_salted(stream, ["topic", "offset"], "1 hour")
    finish(stream_parts(unique, f"{base}/rows", f"{base}/checkpoint", NOW))
    return naive(read_parts(spark, f"{base}/rows", unique.schema))
