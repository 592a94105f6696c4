"""Message topics.

The Kafka connector is a separate Spark package (``spark-sql-kafka-0-10``) that the session has to bring.
Where it is missing these functions fail on ``load``; everything behind them takes any table of the same
columns, and the tests feed it from files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators.envelope import envelope


def topic_options(
    topics: str | Sequence[str],
    servers: str,
    starting: str = "earliest",
    fail_on_data_loss: bool | None = None,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Source options.

    ``starting`` counts only for a query without a checkpoint. ``min_partitions`` lets several tasks share
    one busy topic partition. ``fail_on_data_loss`` stays at Spark's default unless given.
    """
    names = [topics] if isinstance(topics, str) else list(topics)
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(names),
        "startingOffsets": starting,
    }
    if fail_on_data_loss is not None:
        options["failOnDataLoss"] = str(fail_on_data_loss).lower()
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def read_topic(
    spark: SparkSession, topic: str | Sequence[str], servers: str, keep: Sequence[str] = (), **options
) -> DataFrame:
    """One topic (or several) as a stream of envelope rows (S1, P1). Options as in :func:`topic_options`."""
    reader = spark.readStream.format("kafka").options(**topic_options(topic, servers, **options))
    return envelope(reader.load(), keep=keep)


def read_topics(
    spark: SparkSession, topics: Sequence[str], servers: str, keep: Sequence[str] = (), **options
) -> dict[str, DataFrame]:
    """One independent stream per topic (S3).

    The other form is a single :func:`read_topic` over all topics and a sink with ``partition_by="topic"``
    (T9): one query and one checkpoint, but a failure then stops all feeds.
    """
    return {topic: read_topic(spark, topic, servers, keep, **options) for topic in topics}


def scan_topics(spark: SparkSession, topics: Sequence[str], servers: str) -> DataFrame:
    """All retained messages of the topics as a batch."""
    options = topic_options(topics, servers)
    return spark.read.format("kafka").options(**options).load()


def end_offsets(messages: DataFrame) -> DataFrame:
    """End offset per ``(topic, partition)``: largest offset + 1.

    Equal to the broker's end offset while the newest message of the partition is still there. Each task
    sends at most one row per partition it saw.
    """
    return messages.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))


def reported_offsets(spark: SparkSession, progress: str) -> DataFrame:
    """End offsets as a running query last saw them at the broker, without reading a message.

    ``progress`` is the JSON of ``query.lastProgress`` of a query over :func:`read_topic`. One row per topic
    partition, as :func:`end_offsets`.
    """
    latest = F.from_json(
        F.get_json_object("progress", "$.sources[0].latestOffset"), "MAP<STRING, MAP<STRING, BIGINT>>"
    )
    return (
        spark.createDataFrame([(progress,)], "progress STRING")
        .select(F.explode(latest).alias("topic", "partitions"))
        .select("topic", F.explode("partitions").alias("partition", "end_offset"))
        .select("topic", F.col("partition").cast("int").alias("partition"), "end_offset")
    )
