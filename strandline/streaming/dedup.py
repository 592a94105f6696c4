"""Stateful stream dedup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_within_watermark(
    df: DataFrame, keys: Sequence[str], delay: str, time_column: str = "timestamp"
) -> DataFrame:
    """First row per key, remembered for ``delay`` beyond the watermark.

    Not the batch dedup: a row older than the watermark is dropped even if its key is new, and a key that
    comes back after its state expired is emitted again. In return the state is bounded by ``delay``.
    The number of state partitions is fixed by the first run of a checkpoint, so set
    ``spark.sql.shuffle.partitions`` for the cluster before that. Rows are not reduced ahead of the shuffle; where
    one key may hold a large share of a micro-batch, use ``stream_parts(new_keys=...)``, which does that, and
    which is exact for any delay. ``time_column`` must be a timestamp with
    zone semantics.
    """
    return df.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(list(keys))


def first_within_watermark_salted(
    df: DataFrame, keys: Sequence[str], delay: str, salts: int = 64, time_column: str = "timestamp"
) -> DataFrame:
    """:func:`first_within_watermark` for keys of very many rows: two chained stateful operators.

    The first keeps one row for each key and salt, which is the number of the task that read the row, so the copies of a hot key are
    dealt to as many places as there are tasks, up to ``salts``. The second keeps one row for each key and
    meets no more than ``salts`` of them while the first remembers. A row that is read again under another salt is stopped by the
    second, so which task read it changes nothing. The state holds a key up to ``salts + 1`` times.

    Rows behind the watermark are dropped by the first operator and counted there: ``late_rows`` of
    ``streaming.consumer_lag`` says how many.
    """
    salted = df.withWatermark(time_column, delay).withColumn("_salt", F.spark_partition_id() % salts)
    once = salted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return once.dropDuplicatesWithinWatermark(list(keys))
