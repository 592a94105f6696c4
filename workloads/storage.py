"""Queries over how tables are laid out: buckets, curves, days, swapped definitions, sketches of days."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.contracts import CONDITIONS, ENVELOPE
from strandline.operators import envelope, to_silver
from strandline.operators import profile as profiles
from strandline.operators.parse import LOG_KEY
from strandline.plans.ingest import ingest
from strandline.plans.silver import silver_schema
from strandline.session import scratch_dir
from strandline.sinks import batch_overwrite, buckets_for, keep_new_bucketed, register_versioned, run_sql, write_bucketed
from strandline.sources import read_files, recent_days, stream_days
from strandline.streaming import read_parts
from workloads import sql
from workloads.batch import new_namespace
from workloads.messages import conditions_bronze, events, events_stream, naive, props_messages, replayed, table
from workloads.registry import query
from workloads.streams import NOW, finish


@query("SELECT event_type AS topic, count(*) AS n, TRUE AS keys_within, TRUE AS ranks_within FROM events GROUP BY event_type")
def lag_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag and distinct keys from sketches of days, held against exact numbers by their stated errors"""
    base = scratch_dir(spark, "profile")
    lag = F.make_dt_interval(secs=F.col("user_id") * 7 % 600)
    rows = events(spark, sf_dir).select(
        F.col("event_type").alias("topic"), F.col("ts").alias("timestamp"), (F.col("ts") - lag).alias("event_time"), "event_id"
    )
    profiles.daily_sketches(rows, ["event_id"]).write.parquet(f"{base}/days")
    found = profiles.lag_profile(spark.read.parquet(f"{base}/days"))
    seconds = F.unix_seconds("timestamp") - F.unix_seconds("event_time")
    within = F.lit(True)
    exact = [F.count_distinct("event_id").alias("exact")]
    for share in profiles.QUANTILES:
        at = f"lag_p{round(share * 100)}"
        exact += [F.avg((seconds < F.col(at)).cast("int")).alias(f"below_{at}"), F.avg((seconds <= F.col(at)).cast("int")).alias(f"to_{at}")]
        within &= F.col(f"below_{at}") <= share + profiles.RANK_ERROR
        within &= F.col(f"to_{at}") >= share - profiles.RANK_ERROR
    held = rows.join(found, "topic").groupBy("topic", "n", "keys").agg(*exact)
    near = F.abs(F.col("keys") - F.col("exact")) <= profiles.KEY_ERROR * F.col("exact")
    return held.select("topic", "n", near.alias("keys_within"), within.alias("ranks_within"))


@query(
    """
    SELECT event_id % 3 = 0 AS held, event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
           value + 273.15e0 AS temp
    FROM events
    """
)
def handoff_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows lies in a bucketed table; of all rows, three times over, the others are new"""
    base = scratch_dir(spark, "buckets")
    name = new_namespace(spark, base)
    silver = to_silver(conditions_bronze(events(spark, sf_dir), ["partition", "offset"]), CONDITIONS, LOG_KEY)
    rows = table(spark, sf_dir, "events").count()  # what both parts together hold
    held = write_bucketed(silver.filter("offset % 3 = 0"), f"{name}.silver", f"{base}/silver", LOG_KEY, buckets_for(rows))
    new = keep_new_bucketed(replayed(silver), f"{name}.silver", LOG_KEY)
    first, second = (part.select(F.lit(flag).alias("held"), *LOG_KEY, "temp") for flag, part in ((True, held), (False, new)))
    return first.unionByName(second)


_BOX = "ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00' AND value BETWEEN 40 AND 60"


@query(sql.select(sql.CONDITIONS, ["timestamp", "lat", "lon", "temp", "city_id"], where=_BOX))
def clustered_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 Q1: a week and a strip of latitude, from files that are sorted along a curve through both"""
    base = scratch_dir(spark, "curve")
    month = [datetime(2024, 1, day, tzinfo=timezone.utc) for day in (1, 31)]
    silver = to_silver(conditions_bronze(events(spark, sf_dir)), CONDITIONS)
    batch_overwrite(silver, f"{base}/silver", cluster_by={"timestamp": tuple(month), "lat": (0.0, 100.0)})
    rows = read_files(spark, f"{base}/silver", silver_schema(spark, CONDITIONS))
    day = lambda text: F.lit(f"{text}T00:00:00Z").cast("timestamp")
    box = (F.col("timestamp") >= day("2024-01-08")) & (F.col("timestamp") < day("2024-01-15")) & F.col("lat").between(40, 60)
    return naive(rows.filter(box).select("timestamp", "lat", "lon", "temp", "city_id"))


@query(sql.select(sql.ENVELOPE, where="ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-14 00:00:00'"))
def stream_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of a job, each listing the last days only; what one has read the next leaves alone"""
    base = scratch_dir(spark, "days")
    finish(ingest(envelope(props_messages(events_stream(spark, sf_dir))), f"{base}/bronze", f"{base}/first", NOW))
    for today in (8, 10, 12):
        days = recent_days(datetime(2024, 1, today, 6, tzinfo=timezone.utc), 3)
        source = stream_days(spark, f"{base}/bronze", ENVELOPE, days)
        finish(ingest(source, f"{base}/copy", f"{base}/second", NOW))
    return naive(read_parts(spark, f"{base}/copy", ENVELOPE))


@query("SELECT user_id, CAST(value AS VARCHAR) AS value FROM events WHERE event_type = 'view'")
def table_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 Q2: a table whose next definition lacks a column and has another in a new type, swapped in one step"""
    base = scratch_dir(spark, "versions")
    name = new_namespace(spark, base)
    rows = events(spark, sf_dir).filter("event_type = 'view'")
    rows.select("event_id", "user_id", "value").write.parquet(f"{base}/first")
    rows.select("user_id", F.col("value").cast("string").alias("value")).write.parquet(f"{base}/second")
    for version in ("first", "second"):
        register_versioned(spark, f"{name}.seen", f"{base}/{version}")
    return run_sql(spark, f"SELECT user_id, value FROM {name}.seen")
