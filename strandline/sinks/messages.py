"""Publishing rows as JSON messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import json_bytes


def publish_json(
    df: DataFrame, topic: str | Column, columns: Sequence[str | Column] | None = None, key: str | None = None
) -> DataFrame:
    """Rows as ``(topic, [key,] value)`` with the value in UTF-8 JSON bytes."""
    name = topic if isinstance(topic, Column) else F.lit(topic)
    selected = [name.alias("topic")]
    if key:
        selected.append(F.col(key).cast("string").cast("binary").alias("key"))
    return df.select(*selected, json_bytes(*(columns or df.columns)).alias("value"))


def send_to_topic(messages: DataFrame, servers: str) -> None:
    """Write published rows to the broker (K4). Needs the Kafka package, see ``sources.topics``."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
