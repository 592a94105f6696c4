"""Messages to bronze."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strandline.contracts import ENVELOPE, TRIGGER_INTERVAL
from strandline.sources.files import read_files
from strandline.streaming.sinks import PARTS_DEPTH, days_path, stream_append, stream_parts


def ingest(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = TRIGGER_INTERVAL,
    parts: bool = True,
    name: str | None = None,
) -> StreamingQuery:
    """Append envelope rows to bronze as they are, unparsed (K1).

    The sink without a log is the default: a batch that runs again replaces its own rows, and a checkpoint
    reset can not silence it (H8). Read it with ``streaming.read_parts``. ``parts=False`` takes Spark's file sink.
    """
    sink = stream_parts if parts else stream_append
    return sink(messages, path, checkpoint, every=every, name=name)


def fan_out(
    streams: Mapping[str, DataFrame],
    base: str,
    checkpoints: str,
    every: str | None = TRIGGER_INTERVAL,
    parts: bool = True,
) -> dict[str, StreamingQuery]:
    """One independent query, location and checkpoint per feed (S3, T3). Watch them with ``streaming.watch``."""
    return {
        feed: ingest(
            df, f"{base.rstrip('/')}/{feed}", f"{checkpoints.rstrip('/')}/{feed}", every, parts, name=None
        )
        for feed, df in streams.items()
    }


def fan_out_one_stream(
    messages: DataFrame,
    base: str,
    checkpoint: str,
    every: str | None = TRIGGER_INTERVAL,
    partition_by: str = "topic",
) -> StreamingQuery:
    """All topics in one query, split by the sink's directories (T9). Read back with :func:`read_fan_out`.

    The sink without a log: a batch that was written but not committed replaces its own rows when it is run again.
    """
    return stream_parts(messages, base, checkpoint, every=every, split_by=partition_by)


def read_fan_out(
    spark: SparkSession,
    base: str,
    schema: str = ENVELOPE,
    values: Sequence[str] = ("*",),
    split_by: str = "topic",
    days: Sequence[str] | None = None,
) -> DataFrame:
    """The rows of :func:`fan_out_one_stream`, all or those of some topics and days; others are not even listed."""
    places = "{" + ",".join(values) + "}" if len(values) > 1 else values[0]
    where = days_path(f"{base.rstrip('/')}/{split_by}={places}", days)
    return read_files(spark, where, schema, depth=PARTS_DEPTH - 1, base_path=base)
