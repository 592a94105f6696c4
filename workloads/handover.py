"""Handoff by place in the log, late rows, quarantine in the jobs, redefined tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.contracts import CONDITIONS, ENVELOPE
from strandline.functions import utc_day
from strandline.operators import after, envelope, keep_new, to_silver, up_to
from strandline.operators.parse import LOG_KEY, missing_values
from strandline.plans.backfill import backfill, silver_rows
from strandline.plans.incremental import incremental
from strandline.plans.ingest import ingest
from strandline.plans.silver import silver_schema, silver_view
from strandline.session import scratch_dir
from strandline.sinks import register_external, run_sql
from strandline.sources import read_files, stream_files
from strandline.streaming import compact_parts, read_compacted, read_parts
from workloads import sql
from workloads.batch import PROPS, new_namespace
from workloads.messages import conditions_bronze, cut_short, events, events_stream, files_for, landed, naive, props_messages
from workloads.registry import query
from workloads.streams import NOW, finish

_HALF = "(SELECT max(event_id) // 2 FROM events)"

# Names one message where several bear the same time: the time, by which the stream finds its days, and the place in the log (H2).
TIME_AND_PLACE = ["timestamp", *LOG_KEY]


def _by_day(rows: DataFrame) -> DataFrame:
    """Messages that bear the start of their day as time, so that many share one."""
    return rows.withColumn("ts", F.date_trunc("day", "ts"))


@query(
    f"""
    SELECT CASE WHEN event_id <= {_HALF} THEN 'backfill' ELSE 'stream' END AS part, date_trunc('day', ts) AS "timestamp",
           event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset", value + 273.15e0 AS temp
    FROM events
    """
)
def handoff_by_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The halves meet at an offset of each partition; times across the cut are the same"""
    base = scratch_dir(spark, "offsets")
    rows = _by_day(events(spark, sf_dir))
    half = rows.agg(F.max("event_id")).first()[0] // 2
    history = conditions_bronze(rows.filter(F.col("event_id") <= half), keep=["partition", "offset"])
    report = backfill(history, CONDITIONS, f"{base}/backfill", keys=LOG_KEY, keep=LOG_KEY)
    stream = conditions_bronze(_by_day(events_stream(spark, sf_dir)), keep=["partition", "offset"])
    finish(
        incremental(
            stream, CONDITIONS, f"{base}/stream", f"{base}/checkpoint", every=NOW, keep=LOG_KEY, positions=report.positions
        )
    )
    schema = silver_schema(spark, CONDITIONS, LOG_KEY)
    halves = {"backfill": read_files(spark, f"{base}/backfill", schema), "stream": read_parts(spark, f"{base}/stream", schema)}
    first, second = (
        half.select(F.lit(name).alias("part"), "timestamp", *LOG_KEY, "temp") for name, half in halves.items()
    )
    return naive(first.unionByName(second))


@query(sql.select(sql.CONDITIONS | {"topic": "event_type", "partition": "CAST(user_id % 4 AS INTEGER)", "offset": "event_id"}))
def stream_log_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream adds by place in the log, which says what the time is, to a backfill of half the rows"""
    base = scratch_dir(spark, "logkey")
    keep = ["partition", "offset"]
    history = up_to(conditions_bronze(events(spark, sf_dir), keep), sql.CUTOFF)
    backfill(history, CONDITIONS, f"{base}/backfill", keys=LOG_KEY, keep=LOG_KEY, by_day=True)
    finish(
        incremental(
            conditions_bronze(events_stream(spark, sf_dir), keep), CONDITIONS, f"{base}/stream", f"{base}/checkpoint",
            every=NOW, new_keys=LOG_KEY, keep=LOG_KEY, backfill_path=f"{base}/backfill", backfill_by_day=True,
            time_bounded=True,
        )
    )
    return naive(silver_view(spark, CONDITIONS, f"{base}/backfill", f"{base}/stream", by_day=True, keep=LOG_KEY))


_LATE = "CASE WHEN event_id = (SELECT max(event_id) FROM events) THEN ts - INTERVAL 365 DAY ELSE ts END"


@query(sql.select({"timestamp": _LATE, "temp": "value + 273.15e0", "city_id": "CAST(user_id AS INTEGER)"}))
def stream_late_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream adds by time, and one row of it is a year late"""
    base = scratch_dir(spark, "late")
    rows = events(spark, sf_dir)
    last = rows.agg(F.max("event_id")).first()[0]

    def late(some: DataFrame) -> DataFrame:
        shifted = F.col("ts") - F.make_dt_interval(days=F.lit(365))
        return some.withColumn("ts", F.when(F.col("event_id") == last, shifted).otherwise(F.col("ts")))

    keep = ["partition", "offset"]
    history = up_to(conditions_bronze(rows.filter(F.col("event_id") != last), keep), sql.CUTOFF)
    backfill(history, CONDITIONS, f"{base}/backfill", keys=TIME_AND_PLACE, keep=LOG_KEY, by_day=True)
    finish(
        incremental(
            conditions_bronze(late(events_stream(spark, sf_dir)), keep), CONDITIONS, f"{base}/stream", f"{base}/checkpoint",
            every=NOW, new_keys=TIME_AND_PLACE, keep=LOG_KEY, backfill_path=f"{base}/backfill", backfill_by_day=True,
        )
    )
    view = silver_view(spark, CONDITIONS, f"{base}/backfill", f"{base}/stream", by_day=True)
    return naive(view.select("timestamp", "temp", "city_id"))


@query(
    f"""
    SELECT rule, {sql.columns(sql.CONDITIONS)} FROM events, (VALUES ('batch'), ('stream')) AS rules(rule)
    """
)
def dedup_prefers_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 H3 H5: of a full reading, an error reply, an empty list and broken text with one key the first stays"""
    full = conditions_bronze(events(spark, sf_dir), ["partition", "offset"])
    copies = full
    for text in ('{"cod":401}', '{"weather":[]}', "{"):
        copies = copies.unionByName(full.withColumn("json_str", F.lit(text)))
    batch = silver_rows(copies, CONDITIONS, TIME_AND_PLACE)
    parsed = to_silver(copies, CONDITIONS, LOG_KEY)
    stream = keep_new(parsed, parsed.limit(0), TIME_AND_PLACE, [missing_values(CONDITIONS)]).drop(*LOG_KEY)
    return naive(
        batch.select(F.lit("batch").alias("rule"), "*").unionByName(stream.select(F.lit("stream").alias("rule"), "*"))
    )


_REJECTED = """
    SELECT event_type AS topic, ts AS "timestamp", left(props, length(props) - 1) AS raw, 'malformed' AS verdict
    FROM events WHERE event_type = 'click'
"""
_SOUND = """
    SELECT ts AS "timestamp", CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE event_type <> 'click'
"""
_SIDE = f"{ENVELOPE}, raw STRING, verdict STRING"


def _quarantined_backfill(spark: SparkSession, sf_dir: str) -> str:
    base = scratch_dir(spark, "quarantine")
    bronze = cut_short(envelope(props_messages(events(spark, sf_dir)), ["partition", "offset"]), "click")
    backfill(bronze, PROPS, base, keys=TIME_AND_PLACE, quarantine=True)
    return base


@query(_REJECTED)
def backfill_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 H5 H6: the rows that the backfill turned away, with their text"""
    base = _quarantined_backfill(spark, sf_dir)
    side = read_files(spark, f"{base}/part=quarantine", _SIDE)
    return naive(side.select("topic", "timestamp", "raw", "verdict"))


@query(_SOUND)
def backfill_quarantine_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 H5: silver without them"""
    base = _quarantined_backfill(spark, sf_dir)
    return naive(read_files(spark, f"{base}/part=silver", silver_schema(spark, PROPS)))


def _quarantined_stream(spark: SparkSession, sf_dir: str) -> str:
    """By key, over a backfill of the first half, so that rejected rows are not repeated either."""
    base = scratch_dir(spark, "quarantine")
    keep = ["partition", "offset"]
    history = up_to(cut_short(envelope(props_messages(events(spark, sf_dir)), keep), "click"), sql.CUTOFF)
    backfill(history, PROPS, f"{base}/backfill", keys=TIME_AND_PLACE, quarantine=True)
    stream = cut_short(envelope(props_messages(events_stream(spark, sf_dir)), keep), "click")
    finish(
        incremental(
            stream, PROPS, f"{base}/stream", f"{base}/checkpoint", every=NOW, new_keys=TIME_AND_PLACE, keep=LOG_KEY,
            backfill_path=f"{base}/backfill", quarantine=True,
        )
    )
    return base


@query(_REJECTED)
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What backfill and stream together turned away"""
    base = _quarantined_stream(spark, sf_dir)
    sides = read_files(spark, f"{base}/backfill/part=quarantine", _SIDE).unionByName(
        read_parts(spark, f"{base}/stream/part=quarantine", _SIDE)
    )
    return naive(sides.select("topic", "timestamp", "raw", "verdict"))


@query(_SOUND)
def stream_quarantine_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both halves of silver without them"""
    base = _quarantined_stream(spark, sf_dir)
    return naive(silver_view(spark, PROPS, f"{base}/backfill/part=silver", f"{base}/stream/part=silver"))


@query("SELECT event_id, value FROM events WHERE event_type = 'view'")
def table_redefined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 Q2: a table that is registered again, over other files with other columns"""
    base = scratch_dir(spark, "redefined")
    name = new_namespace(spark, base)
    rows = events(spark, sf_dir)
    rows.filter("event_type = 'click'").select("event_id").write.parquet(f"{base}/first")
    rows.filter("event_type = 'view'").select("event_id", "value").write.parquet(f"{base}/second")
    for version in ("first", "second"):
        register_external(spark, f"{name}.seen", f"{base}/{version}")
    return run_sql(spark, f"SELECT event_id, value FROM {name}.seen")


@query(sql.select(sql.ENVELOPE))
def compacted_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small files of finished days, merged while the stream goes on"""
    base = scratch_dir(spark, "compact")
    bronze = envelope(props_messages(events(spark, sf_dir)))
    schema = bronze.schema
    earlier, later = up_to(bronze, sql.CUTOFF), after(bronze, sql.CUTOFF)
    files = files_for(spark, sf_dir, 8)
    for half in (earlier, later):
        landed(half, f"{base}/landed", 4 * files, "append")
        source = stream_files(spark, f"{base}/landed", schema, max_files_per_trigger=files)
        finish(ingest(source, f"{base}/rows", f"{base}/checkpoint", NOW))
        if half is earlier:
            days = [r["day"] for r in bronze.select(utc_day(F.col("timestamp")).alias("day")).distinct().collect()]
            compact_parts(spark, f"{base}/rows", f"{base}/merged", schema, f"{base}/checkpoint", days)
    return naive(read_compacted(spark, f"{base}/rows", f"{base}/merged", schema))
