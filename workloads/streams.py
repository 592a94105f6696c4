"""Streaming queries. Each runs to the end of its input and returns what the sink holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandline.contracts import AIR_QUALITY, CONDITIONS, ENVELOPE
from strandline.operators import envelope, to_silver, up_to
from strandline.plans.backfill import backfill
from strandline.plans.incremental import incremental
from strandline.plans.ingest import fan_out, fan_out_one_stream, ingest, read_fan_out
from strandline.plans.silver import silver_schema, silver_view
from strandline.session import scratch_dir
from strandline.streaming import first_within_watermark, read_parts, stream_parts, watch
from workloads import sql
from workloads.messages import (
    air_quality_bronze,
    conditions_bronze,
    events,
    events_stream,
    naive,
    props_messages,
    replayed,
)
from workloads.registry import query

NOW = None  # trigger: take what is there, then stop


def finish(*queries: StreamingQuery) -> None:
    outcomes = watch({str(i): q for i, q in enumerate(queries)})
    failed = [o.error for o in outcomes if not o.ok]
    if failed:
        raise RuntimeError(failed[0])


@query(sql.select(sql.ENVELOPE))
def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 K1 T1 T2 T3"""
    base = scratch_dir(spark, "bronze")
    stream = envelope(props_messages(events_stream(spark, sf_dir)))
    finish(ingest(stream, f"{base}/rows", f"{base}/checkpoint", NOW))
    return naive(read_parts(spark, f"{base}/rows", ENVELOPE))


@query(sql.select(sql.CONDITIONS, where=f"ts > {sql.CUTOFF_SQL}"))
def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream half of silver"""
    base = scratch_dir(spark, "silver")
    bronze = conditions_bronze(events_stream(spark, sf_dir))
    finish(incremental(bronze, CONDITIONS, f"{base}/rows", f"{base}/checkpoint", cutoff=sql.CUTOFF, every=NOW))
    return naive(read_parts(spark, f"{base}/rows", silver_schema(spark, CONDITIONS)))


@query(sql.one_per(sql.AIR_QUALITY, ["timestamp"]))
def stream_handoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backfill of half the rows, then a stream over all of them by key, read as one table"""
    base = scratch_dir(spark, "handoff")
    history = up_to(air_quality_bronze(events(spark, sf_dir)), sql.CUTOFF)
    backfill(history, AIR_QUALITY, f"{base}/backfill")
    finish(
        incremental(
            air_quality_bronze(events_stream(spark, sf_dir)),
            AIR_QUALITY,
            f"{base}/stream",
            f"{base}/checkpoint",
            every=NOW,
            new_keys=["timestamp"],
            backfill_path=f"{base}/backfill",
        )
    )
    return naive(silver_view(spark, AIR_QUALITY, f"{base}/backfill", f"{base}/stream"))


@query('SELECT event_type AS topic, count(*) AS n, max(ts) AS latest FROM events GROUP BY event_type')
def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream, split by the sink"""
    base = scratch_dir(spark, "fanout")
    stream = envelope(props_messages(events_stream(spark, sf_dir)))
    finish(fan_out_one_stream(stream, f"{base}/rows", f"{base}/checkpoint", NOW))
    rows = read_fan_out(spark, f"{base}/rows")
    return naive(rows.groupBy("topic").agg(F.count(F.lit(1)).alias("n"), F.max("timestamp").alias("latest")))


@query(
    """
    SELECT feed, count(*) AS n, min(ts) AS earliest, max(ts) AS latest
    FROM events, (VALUES ('air_quality'), ('conditions')) AS feeds(feed) GROUP BY feed
    """
)
def stream_per_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 T4: one query, location and checkpoint per feed, both at once"""
    base = scratch_dir(spark, "feeds")
    streams = {
        "conditions": conditions_bronze(events_stream(spark, sf_dir)),
        "air_quality": air_quality_bronze(events_stream(spark, sf_dir)),
    }
    finish(*fan_out(streams, f"{base}/bronze", f"{base}/checkpoints", NOW).values())
    parts = [read_parts(spark, f"{base}/bronze/{feed}", ENVELOPE).withColumn("feed", F.lit(feed)) for feed in streams]
    rows = parts[0].unionByName(parts[1])
    return naive(
        rows.groupBy("feed").agg(
            F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("earliest"), F.max("timestamp").alias("latest")
        )
    )


@query(sql.one_per(sql.ENVELOPE, ["topic", "timestamp"]))
def replay_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checkpoint is lost and everything is read again"""
    base = scratch_dir(spark, "replay")
    for attempt in ("first", "second"):
        stream = envelope(props_messages(events_stream(spark, sf_dir)))
        finish(
            stream_parts(stream, f"{base}/rows", f"{base}/checkpoint-{attempt}", NOW, new_keys=["topic", "timestamp"])
        )
    return naive(read_parts(spark, f"{base}/rows", ENVELOPE))


@query(sql.one_per(sql.CONDITIONS, ["timestamp"]))
def dedup_microbatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dedup inside each micro-batch"""
    base = scratch_dir(spark, "microbatch")
    finish(
        stream_parts(
            replayed(conditions_bronze(events_stream(spark, sf_dir))),
            f"{base}/rows",
            f"{base}/checkpoint",
            NOW,
            dedup_keys=["timestamp"],
            raw_dedup=True,
            prepare=lambda rows: to_silver(rows, CONDITIONS),
        )
    )
    return naive(read_parts(spark, f"{base}/rows", silver_schema(spark, CONDITIONS)))


@query(sql.select(sql.ENVELOPE | {"offset": "event_id"}))
def dedup_watermark_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stateful dedup; the copies of a message arrive together, so none outlives its state"""
    base = scratch_dir(spark, "watermark")
    stream = replayed(envelope(props_messages(events_stream(spark, sf_dir)), keep=["offset"]))
    unique = first_within_watermark(stream, ["topic", "offset"], "1 hour")
    finish(stream_parts(unique, f"{base}/rows", f"{base}/checkpoint", NOW))
    return naive(read_parts(spark, f"{base}/rows", unique.schema))
