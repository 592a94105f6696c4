"""Tables that are dealt by key when they are written, so that later joins by that key don't move them."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators.dedup import keep_one


# Rows of one bucket of a table, a few hundred megabytes in memory with copies of each.
BUCKET_ROWS = 250_000


def buckets_for(rows: int, least: int = 4) -> int:
    """Buckets of a table that will hold ``rows``: a larger table has more of them, not larger ones."""
    return max(least, math.ceil(rows / BUCKET_ROWS))


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write an external table in ``buckets`` buckets by ``keys``, each sorted by them.

    The rows are dealt to the buckets by one shuffle, so there is one file for each. The number is fixed for the table: choose it for the
    size it will have, see :func:`buckets_for`.
    """
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode("overwrite")
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def buckets_of(spark: SparkSession, table: str) -> int:
    rows = spark.sql("DESCRIBE EXTENDED IDENTIFIER(:table)", args={"table": table})
    found = rows.where(F.trim("col_name") == "Num Buckets").first()
    if found is None:
        raise ValueError(f"{table} is not bucketed")
    return int(found["data_type"])


def keep_new_bucketed(
    df: DataFrame, table: str, keys: Sequence[str], order_by: Sequence[str | Column] = ()
) -> DataFrame:
    """One row per key of ``df``, without the keys that the bucketed ``table`` has.

    Only ``df`` is shuffled, once, into the table's buckets; there it is made unique and meets the keys that lie in the bucket. Where
    the table is large and ``df`` is not, that is the cheapest handoff by key. A row with a null in its key is always new, and
    copies of a hot key cross the shuffle one by one: ``keep_new`` reduces them first, but moves the loaded keys.
    """
    spark = df.sparkSession
    unique = keep_one(df.repartition(buckets_of(spark, table), *keys), keys, order_by)
    loaded = spark.table(table).select(*(F.col(key).alias(f"_loaded_{key}") for key in keys))
    same = reduce(Column.__and__, (F.col(key) == F.col(f"_loaded_{key}") for key in keys))
    # Sorted buckets are merged; a broadcast or a hash of the loaded side would hold all its keys.
    return unique.join(loaded.hint("merge"), same, "left_anti")
