"""The whole flow over files that arrive in steps: bronze, backfill, stream, table, health."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from strandline import AIR_QUALITY, CONDITIONS
from strandline.operators import envelope, health
from strandline.plans import backfill, incremental, ingest, setup_checks, silver_view
from strandline.sinks import register_view, run_sql
from strandline.sources import stream_bronze
from strandline.streaming import PARTS_DEPTH, read_parts, watch
from workloads.messages import air_quality_payload, conditions_payload, events, messages

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "topic STRING, timestamp TIMESTAMP, json_str STRING, partition INT, offset BIGINT"
RAW = "topic STRING, timestamp TIMESTAMP, value BINARY, partition INT, offset BIGINT"
LOG_KEY = ["topic", "timestamp", "partition", "offset"]


@pytest.mark.parametrize(("feed", "payload"), [(CONDITIONS, conditions_payload), (AIR_QUALITY, air_quality_payload)])
def test_flow(spark, tmp_path, feed, payload):
    sent = messages(events(spark, SF_DIR), payload())
    total = sent.count()
    base = str(tmp_path)

    def arrive(part):
        part.coalesce(2).write.mode("append").parquet(f"{base}/log")

    def to_bronze(checkpoint="bronze"):
        log = envelope(spark.readStream.schema(RAW).parquet(f"{base}/log"), keep=["partition", "offset"])
        query = ingest(log, f"{base}/bronze", f"{base}/cp/{checkpoint}", every=None, parts=True)
        assert all(o.ok for o in watch({"bronze": query}, timeout=300))

    def to_silver():
        bronze = stream_bronze(spark, f"{base}/bronze", schema=SCHEMA, depth=PARTS_DEPTH)
        query = incremental(
            bronze, feed, f"{base}/silver/stream", f"{base}/cp/silver", every=None,
            new_keys=["timestamp"], backfill_path=f"{base}/silver/backfill",
        )
        assert all(o.ok for o in watch({"silver": query}, timeout=300))

    split = F.lit("2024-01-10T00:00:00Z").cast("timestamp")
    arrive(sent.filter(F.col("timestamp") <= split))
    to_bronze()
    report = backfill(read_parts(spark, f"{base}/bronze", SCHEMA), feed, f"{base}/silver/backfill", cluster=True)
    arrive(sent.filter(F.col("timestamp") > split))
    to_bronze()
    to_silver()
    # The bronze checkpoint is lost: everything is read from the log again.
    to_bronze("bronze-again")
    assert read_parts(spark, f"{base}/bronze", SCHEMA).count() == 2 * total
    to_silver()

    view = silver_view(spark, feed, f"{base}/silver/backfill", f"{base}/silver/stream")
    assert 0 < report.rows < total
    assert view.count() == total and view.select("timestamp").distinct().count() == total

    register_view(spark, feed.name, view)
    low, high = run_sql(spark, f"SELECT min(lat), max(lat) FROM {feed.name}").first()
    assert (low, high) == tuple(events(spark, SF_DIR).agg(F.min("value"), F.max("value")).first())

    topics = ["click", "error", "purchase", "signup", "view"]
    now = datetime.now(timezone.utc) + timedelta(seconds=5)

    def checks(**changes):
        settings = {
            "as_of": now,
            "topics": topics,
            # The test data is old; look at it as if it had been sent just now.
            "log": lambda: sent.withColumn("timestamp", F.lit(now).cast("timestamp")).withColumn("json_str", F.lit("")),
            "messages": lambda: sent,
            "tables": {"bronze": [("log", f"{base}/bronze")], "silver": [("all", f"{base}/silver")]},
        }
        return setup_checks(spark, **{**settings, **changes})

    def statuses(df):
        return [r["status"] for r in health.stage_report(df).orderBy("ord").collect()]

    assert health.verdict(checks()).first()["healthy"]
    assert statuses(checks()) == ["OK"] * 4
    assert statuses(checks(messages=lambda: spark.read.parquet(f"{base}/nowhere"))) == ["OK", "FAIL", "BLOCKED", "BLOCKED"]
    assert statuses(checks(running={"bronze": False})) == ["OK", "OK", "FAIL", "BLOCKED"]
    assert statuses(checks(as_of=now + timedelta(hours=1), log=lambda: sent.limit(0).withColumn("json_str", F.lit(""))))[0] == "FAIL"
    only = checks(stage="silver")
    assert [(r["stage"], r["check"], r["ok"]) for r in only.collect()] == [("silver", "all", True)]
