"""What running queries report of themselves, kept as a table.

A listener takes each progress report as it comes and a thread of its own appends them, so neither the query nor the
listener waits for a write. Lag, end offsets and late rows are read from that table; no message is.
"""

from __future__ import annotations

import queue
import threading
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from strandline.functions import seconds, utc_day
from strandline.operators.dedup import keep_one
from strandline.operators.lists import expected_rows
from strandline.sources.files import read_files

PROGRESS = (
    "name STRING, query_id STRING, run_id STRING, batch_id BIGINT, at STRING, rows_in BIGINT, "
    "duration_ms BIGINT, late_rows BIGINT, progress STRING"
)
_STOP = object()


class ProgressTable(StreamingQueryListener):
    """Append the progress of all queries of a session to Parquet below ``path``, by day.

    Use it as a context or call :meth:`start` and :meth:`close`; closing waits until everything is written. Reports that come while
    a write runs go into the next one together. A report that is there twice, as after a write that was tried again, counts
    once in the functions below.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._waiting: queue.SimpleQueue = queue.SimpleQueue()
        self._writer = threading.Thread(target=self._write_all, daemon=True)
        self._open: set[str] = set()
        self.errors: list[str] = []

    # ------------------------------------------------ what Spark calls

    def onQueryStarted(self, event) -> None:
        self._open.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        report = event.progress
        late = sum(operator.numRowsDroppedByWatermark for operator in report.stateOperators)
        self._waiting.put(
            (
                report.name, str(report.id), str(report.runId), report.batchId, report.timestamp, report.numInputRows,
                report.durationMs.get("triggerExecution"), late, report.json,
            )
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._open.discard(str(event.runId))

    # ------------------------------------------------ the table

    def start(self) -> ProgressTable:
        self.spark.streams.addListener(self)
        self._writer.start()
        return self

    def close(self, timeout: float = 60.0) -> None:
        """Write what has come and stop. All reports of queries that have ended before are among it."""
        # Reports of a query come before the news of its end.
        deadline = time.monotonic() + timeout
        while self._ended() and time.monotonic() < deadline:
            time.sleep(0.02)
        self.spark.streams.removeListener(self)
        self._waiting.put(_STOP)
        self._writer.join(timeout)

    __enter__ = start

    def __exit__(self, *_) -> None:
        self.close()

    def _ended(self) -> set[str]:
        """Queries that have ended without this listener having heard of it."""
        return self._open - {str(query.runId) for query in self.spark.streams.active}

    def _write_all(self) -> None:
        while True:
            rows = [self._waiting.get()]
            while not self._waiting.empty():
                rows.append(self._waiting.get())
            last = _STOP in rows
            rows = [row for row in rows if row is not _STOP]
            try:
                if rows:
                    table = self.spark.createDataFrame(rows, PROGRESS)
                    day = utc_day(F.to_timestamp("at"))
                    table.coalesce(1).withColumn("day", day).write.mode("append").partitionBy("day").parquet(self.path)
            except Exception as error:  # a query must not fail because its progress can't be kept
                self.errors.append(str(error).splitlines()[0])
            if last:
                return


def read_progress(spark: SparkSession, path: str, days: Sequence[str] | None = None) -> DataFrame:
    """The table, each report once; some days (``yyyy-mm-dd``) or all. A location without reports is empty."""
    where = path.rstrip("/") + ("/day=*" if days is None else "/day={" + ",".join(days) + "}")
    rows = read_files(spark, where, PROGRESS, missing_ok=True)
    once = keep_one(rows, ["query_id", "run_id", "batch_id", "at"])
    return once.withColumn("at", F.to_timestamp("at"))


def _newest(progress: DataFrame, *values: Column | str) -> DataFrame:
    """The last report of each query by name, reduced in each task first."""
    newest = F.max(F.struct("at", "batch_id", *values)).alias("newest")
    return progress.groupBy("name").agg(newest).select("name", "newest.*")


_SOURCES = "array<struct<description:string,startOffset:string,endOffset:string,latestOffset:string>>"
_PLACES = "map<string,map<string,bigint>>"


def source_offsets(progress: DataFrame) -> DataFrame:
    """Where each query stood at its last report, for sources that say so by topic and partition, as a broker's do.

    ``name``, ``topic``, ``partition``, ``end_offset`` (consumed up to here, exclusive), ``latest_offset`` (what the broker had)
    and ``lag``, the messages between them.
    """
    sources = F.from_json(F.get_json_object("progress", "$.sources"), _SOURCES)
    each = _newest(progress, "progress").select("name", F.explode(sources).alias("source"))
    ends = F.from_json("source.endOffset", _PLACES)
    latest = F.from_json("source.latestOffset", _PLACES)
    topics = each.select("name", F.explode(ends).alias("topic", "places"), latest.alias("latest"))
    places = topics.select("name", "topic", F.explode("places").alias("place", "end_offset"), "latest")
    seen = F.try_element_at(F.try_element_at("latest", F.col("topic")), F.col("place"))
    return places.select(
        "name",
        "topic",
        F.col("place").cast("int").alias("partition"),
        "end_offset",
        seen.alias("latest_offset"),
        F.greatest(seen - F.col("end_offset"), F.lit(0)).alias("lag"),
    )


def consumer_lag(progress: DataFrame) -> DataFrame:
    """One row for each query (C4, S8, T4): ``name``, its ``batches``, ``rows_in`` and ``late_rows`` in all, ``last_batch``, ``last_at``, and
    ``lag``, the messages it had yet to read at its last report (null where its sources don't tell)."""
    sums = progress.groupBy("name").agg(
        F.count_distinct("query_id", "batch_id").alias("batches"),
        F.sum("rows_in").alias("rows_in"),
        F.sum("late_rows").alias("late_rows"),
        F.max("at").alias("last_at"),
        F.max_by("batch_id", F.struct("at", "batch_id")).alias("last_batch"),
    )
    lag = source_offsets(progress).groupBy("name").agg(F.sum("lag").alias("lag"))
    columns = ("name", "batches", "rows_in", "late_rows", "last_batch", "last_at", "lag")
    return sums.join(lag, "name", "left").select(*columns)


def progress_checks(
    progress: DataFrame,
    expected: Sequence[str],
    as_of: Column,
    limit_seconds: int,
    max_lag: int | None = None,
    stage: str = "bronze",
) -> DataFrame:
    """Result rows (C4, C5): each expected query has reported within ``limit_seconds`` and lags by no more than ``max_lag``.

    A query that has never reported fails, as one that stopped moving does. Reports later than ``as_of`` are left out.
    """
    spark = progress.sparkSession
    state = consumer_lag(progress.where((F.col("at") <= as_of) & F.col("name").isin(list(expected))))
    rows = expected_rows(spark, "name", expected).join(state, "name", "left")
    moving = F.coalesce(F.col("last_at") >= as_of - seconds(limit_seconds), F.lit(False))
    close = F.lit(True) if max_lag is None else F.coalesce(F.col("lag") <= max_lag, F.lit(True))
    age = F.unix_seconds(as_of) - F.unix_seconds("last_at")
    behind = F.coalesce(F.format_string(", %d messages behind", "lag"), F.lit(""))
    behind = F.when(F.col("lag").isNotNull(), behind).otherwise("")
    found = F.concat(F.format_string("batch %d, %d s ago", "last_batch", age), behind)
    return rows.select(
        F.lit(stage).alias("stage"),
        F.col("name").alias("check"),
        (moving & close).alias("ok"),
        F.when(F.col("last_at").isNull(), "no report").otherwise(found).alias("detail"),
    )

