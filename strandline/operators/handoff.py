"""Batch-to-stream handoff: which rows belong to which half.

Three ways (H1):

* by time: the cutoff is the largest ``timestamp`` the backfill really loaded. It needs no shuffle. A row
  that reaches bronze later with an older or the very same ``timestamp`` is in neither half, so it is exact only
  where times strictly rise.
* by place in the log: the backfill reports the largest offset of each topic and partition it loaded, and the
  stream takes what lies behind them. It needs no shuffle either and is exact, ties in time included, because
  offsets rise within a partition.
* by key: the stream drops the keys that are already loaded, see :func:`keep_new`. It is exact for any
  order of arrival.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import instant, iso_utc
from strandline.operators.dedup import keep_one
from strandline.operators.lists import listed


def after(df: DataFrame, cutoff: str | Column | None, column: str = "timestamp") -> DataFrame:
    """Rows strictly later than the cutoff (P10). Reaches the Parquet scan as a pushed filter.

    No cutoff means nothing was loaded before, so all rows pass. A NULL time does not pass (H13).
    """
    return df if cutoff is None else df.filter(F.col(column) > instant(cutoff))


def up_to(df: DataFrame, cutoff: str | Column | None, column: str = "timestamp") -> DataFrame:
    """The complement of :func:`after`: the batch half, NULL times included."""
    if cutoff is None:
        return df.filter(F.lit(False))
    return df.filter((F.col(column) <= instant(cutoff)) | F.col(column).isNull())


def cutoff_metric(column: str = "timestamp") -> Column:
    """Aggregate that :func:`cutoff_text` understands."""
    return F.max(F.unix_micros(column)).alias("cutoff_micros")


def cutoff_text(micros: int | None) -> str | None:
    return None if micros is None else iso_utc(micros)


def cutoff_of(df: DataFrame, column: str = "timestamp") -> str | None:
    """Largest time in a table as zone-free text, ``None`` for an empty one (T5, H1)."""
    return cutoff_text(df.agg(cutoff_metric(column)).first()[0])


def positions_of(df: DataFrame) -> dict[tuple[str, int], int]:
    """Largest ``offset`` of each ``(topic, partition)``: one entry for each partition of the log (T5, H1)."""
    rows = df.groupBy("topic", "partition").agg(F.max("offset").alias("offset")).collect()
    return {(r["topic"], r["partition"]): r["offset"] for r in rows}


def after_positions(df: DataFrame, positions: Mapping[tuple[str, int], int]) -> DataFrame:
    """Rows behind the given places in the log, and all of partitions that are not among them.

    What is surely loaded, at or before the least place of its topic's known partitions, is left out by a filter that reaches the
    scan. The rest meets its partition's place in a join with literal rows, whose size Spark knows: up to its threshold
    they are broadcast and rows are not shuffled, and looking one up costs the same whatever their number.
    """
    if not positions:
        return df
    known = listed(df.sparkSession, "_topic STRING, _partition INT, _last BIGINT", [(t, p, o) for (t, p), o in positions.items()])
    same = F.col("topic").eqNullSafe(F.col("_topic")) & F.col("partition").eqNullSafe(F.col("_partition"))
    joined = df.filter(maybe_new(positions)).join(known, same, "left")
    return joined.filter(F.col("_last").isNull() | (F.col("offset") > F.col("_last"))).drop("_topic", "_partition", "_last")


def maybe_new(positions: Mapping[tuple[str, int], int]) -> Column:
    """False for rows that are surely loaded: at or before the least place of their topic, in one of its known partitions.

    Comparisons of columns with literals only, so that it can be pushed. Partitions that count on are a range.
    """
    keep = F.lit(True)
    partition = F.col("partition")
    for topic in dict.fromkeys(topic for topic, _ in positions if topic is not None):
        own = {number: offset for (name, number), offset in positions.items() if name == topic}
        numbers = sorted(number for number in own if number is not None)
        if len(numbers) < len(own):
            continue
        if numbers[-1] - numbers[0] + 1 == len(numbers):
            unknown = (partition < numbers[0]) | (partition > numbers[-1])
        else:
            unknown = ~partition.isin(numbers)
        elsewhere = ~F.col("topic").eqNullSafe(topic) | partition.isNull() | unknown
        keep &= elsewhere | (F.col("offset") > min(own.values()))
    return keep


def keep_new(
    df: DataFrame, loaded: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = ()
) -> DataFrame:
    """One row per key of ``df``, without the keys that ``loaded`` has. Batch only.

    Both sides go through one keyed aggregate in which a loaded row wins over a new one. So dedup and
    exclusion share a single shuffle, of which ``loaded`` takes part with its key columns alone, hot keys
    are reduced in each task before it, and NULL equals NULL as in the dedup.
    """
    tagged = df.withColumn("_new", F.lit(True))
    held = loaded.select(*keys).withColumn("_new", F.lit(False))
    both = tagged.unionByName(held, allowMissingColumns=True)
    return keep_one(both, keys, ["_new", *order_by]).filter("_new").drop("_new")


def union_parts(*parts: DataFrame) -> DataFrame:
    """All rows of the parts, columns matched by name."""
    first, *others = parts
    for part in others:
        first = first.unionByName(part)
    return first
