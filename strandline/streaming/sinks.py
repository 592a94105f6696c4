"""Streaming sinks.

:func:`stream_append` is Spark's own file sink. :func:`stream_parts` writes every micro-batch into a
directory of its own and leaves no sink log, so it can be read like any other table and survives a
checkpoint reset.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strandline.contracts import TRIGGER_INTERVAL
from strandline.functions import utc_day
from strandline.operators.dedup import keep_one
from strandline.operators.handoff import keep_new
from strandline.sources.files import is_missing, read_files
from strandline.streaming.sketch import parts_without, write_sketch

# day=<ingestion day>/run=<query id>/batch=<batch id>/
PARTS_DEPTH = 3
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Micro-batches at an interval, or with ``every=None`` all that is there now and then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def stream_append(
    df: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = TRIGGER_INTERVAL,
    partition_by: str | Sequence[str] | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to a Parquet location with its own checkpoint.

    With ``partition_by="topic"`` one stream feeds all topics (T9); read that with ``depth=1``.
    Read it through the directory, by Spark's sink log, or live with copies: a batch that was written but not
    committed is written again on restart, and a glob shows both. :func:`stream_parts` has no such trap.
    Do not let a batch job write to the same location: read both halves from places of their own (H9).
    Do not reset the checkpoint and keep the location: the sink log would take the new batches for old
    ones and skip them silently (H8).
    """
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if name:
        writer = writer.queryName(name)
    return triggered(writer, every).start()


def _run_of(spark: SparkSession, checkpoint: str) -> str:
    """Id of the query that owns a checkpoint. A reset checkpoint has a new one."""
    return spark.read.schema("id STRING").json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def _parts_schema(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("run", StringType()), StructField("batch", LongType())])


def days_path(path: str, days: Sequence[str] | None) -> str:
    """The location with its first level narrowed to some days, so that no other day is even listed."""
    return path.rstrip("/") + ("/day=*" if days is None else "/day={" + ",".join(days) + "}")


def read_parts(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    days: Sequence[str] | None = None,
    missing_ok: bool = False,
) -> DataFrame:
    """All rows that :func:`stream_parts` wrote, or those of some ingestion days (``yyyy-mm-dd``).

    A location that holds nothing raises, as a mistyped one would; ``missing_ok`` gives an empty table instead.
    """
    return read_files(spark, days_path(path, days), schema, depth=PARTS_DEPTH - 1, missing_ok=missing_ok)


@dataclass(frozen=True)
class _Span:
    """The ingestion days of a micro-batch, each with its range of times in microseconds."""

    days: list[tuple[str, int, int]]
    with_null: bool

    @classmethod
    def of(cls, rows: DataFrame, column: str) -> _Span:
        # One row per day that the batch touches, reduced in each task first.
        per_day = (
            rows.groupBy(utc_day(F.col(column)).alias("day"))
            .agg(F.min(F.unix_micros(column)).alias("low"), F.max(F.unix_micros(column)).alias("high"))
            .collect()
        )
        dated = sorted((r["day"], r["low"], r["high"]) for r in per_day if r["day"] is not None)
        return cls(dated, len(dated) < len(per_day))

    def path_days(self) -> list[str]:
        # The day of rows without a time also holds the empty part, so there is always something to find.
        return [*(day for day, _, _ in self.days), NO_DAY]

    def keep(self, loaded: DataFrame, column: str) -> DataFrame:
        """The loaded rows that can share a key with the batch: one range for each day, so that a late row
        does not widen the others. The bounds are literals, so Parquet skips the row groups outside of them."""
        inside = F.lit(False)
        for _, low, high in self.days:
            inside |= F.col(column).between(F.timestamp_micros(F.lit(low)), F.timestamp_micros(F.lit(high)))
        if self.with_null:
            inside |= F.col(column).isNull()
        return loaded.filter(inside)


def _write_part(
    rows: DataFrame, path: str, run: str, batch_id: int, time_column: str, shuffled: bool, split_by: str | None
) -> None:
    part = (
        rows.withColumn("day", utc_day(F.col(time_column)))
        .withColumn("run", F.lit(run))
        .withColumn("batch", F.lit(batch_id))
    )
    if shuffled:
        # After a shuffle by key every task holds rows of every day. AQE splits a large day by size.
        part = part.hint("rebalance", F.col("day"))
    (
        part.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*([split_by] if split_by else []), "day", "run", "batch")
        .parquet(path)
    )


def stream_parts(
    df: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = TRIGGER_INTERVAL,
    dedup_keys: Sequence[str] = (),
    new_keys: Sequence[str] = (),
    loaded: Callable[..., DataFrame] | None = None,
    order_by: Sequence[str | Column] = (),
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    time_column: str = "timestamp",
    name: str | None = None,
    time_bounded: bool | None = None,
    split_by: str | None = None,
    sketch: str | None = None,
    raw_dedup: bool = False,
) -> StreamingQuery:
    """Write each micro-batch to ``day=<day>/run=<query id>/batch=<n>`` under ``path``.

    A batch that is run again overwrites its own directories only. A reset checkpoint starts a new run, and
    so never writes over the rows of an older one, however the batches are cut. The day is that of
    ``time_column`` in UTC.

    * ``dedup_keys``: one row per key within a micro-batch (T8), by ``order_by`` and then all columns.
    * ``new_keys``: one row per key in the whole table (T11, H1). The batch is made unique, then rows
      whose key an earlier batch, an earlier run or the ``loaded`` table holds are left out. ``loaded`` is called
      with the session and the days in question, or None for all. With ``time_bounded``, which is the default where
      ``time_column`` is among the keys, a key says what its row's time is. Then only the days that
      the batch touches are listed, and of these only the batch's range of times is read; without it the whole
      table's keys are.
    * ``sketch``: a location for sketches of the keys, for ``new_keys`` that do not say what the time is. Each part gets one behind
      its rows, and only parts that may hold a key of the batch are read, those without a sketch among them.
    * ``split_by``: a column of the rows that becomes the first directory level, as for a side table.
    * ``raw_dedup``: rows of a micro-batch that agree in all columns count once, before ``prepare``. It fits where copies are
      byte-identical, as after a replay, and saves preparing them.

    Without keys the rows pass as they are, with no shuffle (T6). ``prepare`` is applied to each micro-batch
    before that; it must keep ``time_column``.
    """
    schema = (prepare(df) if prepare else df).schema
    runs: list[str] = []
    bounded = time_column in new_keys if time_bounded is None else time_bounded
    if sketch and (bounded or not new_keys):
        raise ValueError("a sketch is for new_keys that do not say what the time is")

    def earlier_rows(
        spark: SparkSession, run: str, batch_id: int, span: _Span | None, skipped: Sequence[tuple[str, int]]
    ) -> DataFrame:
        days = span.path_days() if span else None
        rows = read_files(
            spark,
            days_path(path.rstrip("/") + (f"/{split_by}=*" if split_by else ""), days),
            _parts_schema(schema),
            PARTS_DEPTH - 1,
            missing_ok=True,
            base_path=path,
        ).filter((F.col("run") != run) | (F.col("batch") < batch_id))
        if skipped:  # a condition on directories: their files are not opened
            rows = rows.filter(~F.concat_ws("/", "run", "batch").isin([f"{r}/{b}" for r, b in skipped]))
        timed = [time_column] if span and time_column not in new_keys else []
        seen = rows.select(*new_keys, *timed)
        if loaded is not None:
            seen = seen.unionByName(loaded(spark, days).select(*new_keys, *timed))
        return span.keep(seen, time_column).select(*new_keys) if span else seen

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not runs:
            runs.append(_run_of(spark, checkpoint))
        run = runs[0]
        if raw_dedup:
            batch = keep_one(batch, batch.columns)
        rows = prepare(batch) if prepare else batch
        if new_keys:
            # Reads the batch's raw rows once more, which costs little next to preparing them.
            span = _Span.of(batch, time_column) if bounded else None
            skipped = parts_without(spark, sketch, rows, new_keys) if sketch else ()
            rows = keep_new(rows, earlier_rows(spark, run, batch_id, span, skipped), new_keys, order_by)
        elif dedup_keys:
            rows = keep_one(rows, dedup_keys, order_by)
        _write_part(rows, path, run, batch_id, time_column, bool(new_keys or dedup_keys), split_by)
        if sketch:
            own = f"{path.rstrip('/')}{f'/{split_by}=*' if split_by else ''}/day=*/run={run}/batch={batch_id}"
            written = read_files(spark, own, _parts_schema(schema), missing_ok=True, base_path=path)
            write_sketch(written, new_keys, sketch, run, batch_id)

    if new_keys:
        # An empty part to find, for the first batch of a new table.
        nothing = df.sparkSession.createDataFrame([], schema)
        first = f"/{split_by}={NO_DAY}" if split_by else ""
        nothing.drop(*([split_by] if split_by else [])).write.mode("ignore").parquet(
            f"{path.rstrip('/')}{first}/day={NO_DAY}/run=none/batch=-1"
        )
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    if name:
        writer = writer.queryName(name)
    return triggered(writer, every).start()


# ------------------------------------------------------------------ compaction


def _committed(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that a query has committed, -1 before the first. Later ones may still be written again."""
    try:
        files = spark.read.format("binaryFile").load(f"{checkpoint.rstrip('/')}/commits/[0-9]*")
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return -1
    last = files.select(F.regexp_extract("path", r"/(\d+)$", 1).cast("bigint").alias("batch")).agg(F.max("batch"))
    return -1 if (batch := last.first()[0]) is None else batch


def _placed(schema: StructType) -> StructType:
    return StructType([*_parts_schema(schema).fields, StructField("day", StringType())])


def compact_parts(
    spark: SparkSession, path: str, merged: str, schema: StructType, checkpoint: str, days: Sequence[str]
) -> None:
    """Merge the many small files that a :func:`stream_parts` query wrote for some days.

    The rows of committed batches go to ``day=<day>/run=<query id>`` below ``merged``, in files sized by AQE, together
    with their batch number. Nothing is removed: :func:`read_compacted` takes merged batches from there and
    all others from ``path``, so a batch that runs at the same time, or comes late, is neither lost nor read
    twice. A day may be merged again; that replaces its directory. Merged parts can be deleted at any later time.
    """
    run = _run_of(spark, checkpoint)
    rows = read_files(spark, days_path(path, days), _placed(schema), PARTS_DEPTH - 1, base_path=path)
    rows = rows.filter((F.col("run") == run) & (F.col("batch") <= _committed(spark, checkpoint)))
    (
        rows.hint("rebalance", F.col("day"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day", "run")
        .parquet(merged)
    )


def read_compacted(spark: SparkSession, path: str, merged: str, schema: StructType) -> DataFrame:
    """All rows of :func:`stream_parts`, merged ones from ``merged``.

    What is merged is found from one number for each merged day and run. It becomes a filter on
    directories, so merged parts are not opened.
    """
    done = read_files(spark, merged, _placed(schema), depth=2, missing_ok=True, base_path=merged)
    known = done.groupBy("day", "run").agg(F.max("batch").alias("batch")).collect()
    parts = read_files(spark, days_path(path, None), _placed(schema), PARTS_DEPTH - 1, base_path=path)
    if known:
        places = F.array(*(F.lit(f"{r['day'] or NO_DAY}/{r['run']}") for r in known))
        last = F.map_from_arrays(places, F.array(*(F.lit(r["batch"]) for r in known)))
        own = F.concat_ws("/", F.coalesce("day", F.lit(NO_DAY)), "run")
        parts = parts.filter(F.col("batch") > F.coalesce(F.try_element_at(last, own), F.lit(-1)))
    columns = schema.fieldNames()
    return done.select(*columns).unionByName(parts.select(*columns))
