"""Envelope projection: what is kept of a message."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions import utf8_text


def envelope(messages: DataFrame, keep: Sequence[str] = (), replace_invalid: bool = False) -> DataFrame:
    """``(topic, timestamp, json_str)`` of a message table with a binary ``value``.

    ``keep`` adds columns such as ``partition`` and ``offset``, which make a better dedup key than the
    ingestion time alone (H2).
    """
    return messages.select(
        "topic",
        "timestamp",
        utf8_text(F.col("value"), replace_invalid).alias("json_str"),
        *keep,
    )
