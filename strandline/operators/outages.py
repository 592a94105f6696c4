"""When feeds were silent, from their log.

Recent activity says that a feed is silent now. Here every stretch without a record is found that is as long as a limit or longer,
with its start, its end and its length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strandline.contracts import ACTIVITY_WINDOW_SECONDS, TRIGGER_INTERVAL
from strandline.operators.lists import expected_rows
from strandline.sources.files import read_files
from strandline.streaming.sinks import triggered

MICROS = 1_000_000
SESSIONS = "first TIMESTAMP, last TIMESTAMP, n BIGINT, batch BIGINT"


def active_spans(log: DataFrame, limit_seconds: int, feed: str = "topic", time: str = "timestamp") -> DataFrame:
    """``feed``, ``first``, ``last`` and ``n`` of each span of ``limit_seconds`` on the clock in which the feed has records.

    Tasks reduce their own rows to a row for each span, so a feed that holds most of a log weighs no more than others, and the number
    of spans follows from the time covered, not from the rows. Rows without time are left out.
    """
    span = F.floor(F.unix_micros(time) / (limit_seconds * MICROS)).alias("span")
    timed = log.where(F.col(time).isNotNull())
    return timed.groupBy(feed, span).agg(
        F.min(time).alias("first"), F.max(time).alias("last"), F.count(F.lit(1)).alias("n")
    )


def silences(
    spans: DataFrame, limit_seconds: int, feed: str = "topic", as_of: Column | None = None, expected: Sequence[str] = ()
) -> DataFrame:
    """The silent stretches between active spans (or sessions): ``feed``, ``silent_from``, ``silent_to``, ``seconds``.

    A stretch counts if it is ``limit_seconds`` or longer. With ``as_of`` the time since a feed's last record counts too, up to then;
    spans that begin later are left out. An ``expected`` feed without any record is silent from null on, with null seconds.
    """
    if as_of is not None:
        spans = spans.where(F.col("first") <= as_of)
    ordered = Window.partitionBy(feed).orderBy("first")
    found = spans.select(feed, F.lag("last").over(ordered).alias("silent_from"), F.col("first").alias("silent_to"))
    if as_of is not None:
        now = spans.groupBy(feed).agg(F.max("last").alias("silent_from")).withColumn("silent_to", as_of)
        found = found.unionByName(now)
    length = F.unix_micros("silent_to") - F.unix_micros("silent_from")
    found = found.where(length >= limit_seconds * MICROS).withColumn("seconds", length / MICROS)
    if expected:
        seen = spans.select(feed).distinct()
        never = expected_rows(spans.sparkSession, feed, expected).join(seen, feed, "left_anti")
        end = F.lit(None).cast("timestamp") if as_of is None else as_of
        never = never.select(
            feed, F.lit(None).cast("timestamp").alias("silent_from"), end.alias("silent_to"), F.lit(None).cast("double").alias("seconds")
        )
        found = found.where(F.col(feed).isin(list(expected))).unionByName(never)
    return found


def feed_outages(
    log: DataFrame,
    limit_seconds: int = ACTIVITY_WINDOW_SECONDS,
    feed: str = "topic",
    time: str = "timestamp",
    as_of: Column | None = None,
    expected: Sequence[str] = (),
) -> DataFrame:
    """:func:`silences` of a log, in one pass over it."""
    if as_of is not None:
        log = log.where(F.col(time) <= as_of)
    return silences(active_spans(log, limit_seconds, feed, time), limit_seconds, feed, as_of, expected)


def outage_checks(
    log: DataFrame, expected: Sequence[str], as_of: Column, window_seconds: int, limit_seconds: int, stage: str = "producers"
) -> DataFrame:
    """Result rows: no expected feed was silent for ``limit_seconds`` or longer within ``[as_of - window, as_of]``.

    The bounds on the time reach the scan.
    """
    since = as_of - F.make_dt_interval(secs=F.lit(window_seconds))
    recent = log.where((F.col("timestamp") >= since) & F.col("topic").isin(list(expected)))
    found = feed_outages(recent, limit_seconds, as_of=as_of, expected=expected).groupBy("topic")
    found = found.agg(F.count(F.lit(1)).alias("n"), F.max("seconds").alias("longest"))
    rows = expected_rows(log.sparkSession, "topic", expected).join(found, "topic", "left")
    many = F.format_string("%d silences, the longest of %.0f s", "n", "longest")
    return rows.select(
        F.lit(stage).alias("stage"),
        F.col("topic").alias("check"),
        F.col("n").isNull().alias("ok"),
        F.when(F.col("n").isNull(), f"never silent for {limit_seconds} s")
        .when(F.col("longest").isNull(), "no records")
        .otherwise(many)
        .alias("detail"),
    )


def stream_sessions(
    log: DataFrame,
    path: str,
    checkpoint: str,
    limit_seconds: int = ACTIVITY_WINDOW_SECONDS,
    every: str | None = TRIGGER_INTERVAL,
    feed: str = "topic",
    time: str = "timestamp",
) -> StreamingQuery:
    """Keep the active sessions of each feed up to date in Parquet (C3, S9): read them with :func:`read_sessions`.

    A session ends where a feed is silent for ``limit_seconds``. All sessions stay in the state, one for each silence, so a row that is
    late joins the sessions it bridges. Every micro-batch writes them whole, in turns to one of two places, so that a reader never
    meets a half-written one and a batch that runs again replaces its own. Sessions are merged within each task before the
    shuffle if the session is built with this library's defaults.
    """
    gap = f"{limit_seconds} seconds"
    timed = log.where(F.col(time).isNotNull())
    sessions = timed.groupBy(feed, F.session_window(time, gap).alias("session")).agg(
        F.min(time).alias("first"), F.max(time).alias("last"), F.count(F.lit(1)).alias("n")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.drop("session").withColumn("batch", F.lit(batch_id).cast("bigint"))
        kept.write.mode("overwrite").parquet(f"{path.rstrip('/')}/turn={batch_id % 2}")

    writer = sessions.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(write)
    return triggered(writer, every).start()


def read_sessions(spark: SparkSession, path: str, feed: str = "topic") -> DataFrame:
    """The sessions as the last micro-batch left them: ``feed``, ``first``, ``last``, ``n``. Feed them to :func:`silences`."""
    rows = read_files(spark, path, f"{feed} STRING, {SESSIONS}", depth=1, missing_ok=True)
    last = rows.agg(F.max("batch").alias("batch"))
    return rows.join(F.broadcast(last), "batch").drop("batch")  # one row
