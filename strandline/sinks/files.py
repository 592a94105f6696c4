"""Batch Parquet sink."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strandline.operators.dedup import has_no_order
from strandline.operators.handoff import cutoff_metric, cutoff_text


# Steps into which the bounds of a column are divided along a curve, as a power of two.
CURVE_BITS = 16


def curve_place(bounds: Mapping[str, tuple]) -> Column:
    """The place of a row on a Morton curve through some columns: the bits of their steps in turns, the highest first (K3, Q1).

    ``bounds`` has the least and the greatest value of each column, as literals or columns; values beyond count as the nearest bound,
    nulls as the least. Only comparisons and bit operations, no look at other rows.
    """
    steps = (1 << CURVE_BITS) - 1
    place = F.lit(0).cast("bigint")
    for turn, (name, ends) in enumerate(bounds.items()):
        low, high = (F.lit(end) if not isinstance(end, Column) else end for end in ends)
        if isinstance(ends[0], (datetime, Column)):
            value, low, high = (F.unix_micros(v).cast("double") for v in (F.col(name), low, high))
        else:
            value, low, high = (v.cast("double") for v in (F.col(name), low, high))
        share = F.coalesce((value - low) / (high - low), F.lit(0.0))
        step = F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)) * steps).cast("bigint")
        for bit in range(CURVE_BITS):
            moved = F.shiftleft(F.shiftright(step, bit).bitwiseAND(F.lit(1)), bit * len(bounds) + turn)
            place = place.bitwiseOR(moved)
    return place


@dataclass(frozen=True)
class WriteReport:
    path: str
    rows: int
    cutoff: str | None
    rejected: int = 0
    positions: dict[tuple[str, int], int] = field(default_factory=dict)


def batch_overwrite(
    df: DataFrame,
    path: str,
    max_files: int | None = None,
    max_records_per_file: int | None = None,
    partition_by: str | list[str] | None = None,
    cluster_by: str | Mapping[str, tuple[Column, Column]] | None = None,
    time_column: str = "timestamp",
    counted: Column | None = None,
) -> WriteReport:
    """Overwrite a Parquet location, and report rows written and the cutoff (K3, K7, T5).

    Both numbers are observed in the writing job itself, so nothing runs twice (H11). They are taken in
    the last stage, where Spark counts each task's values once even if the task is run again.

    By default the files follow the tasks of the last stage, which AQE has sized by bytes. ``max_files``
    is for small tables: it spreads the rows over that many writers by one more shuffle, instead of
    squeezing the work before it into as few tasks (H15).

    ``cluster_by`` is for large tables that are read by ranges of a column: it sorts the rows into files by
    that column, so a filter on it skips most files. After a dedup by hash each file spans the whole range.
    Rows that share one value are spread over several files if they are many. For filters on several columns at once
    give their bounds, ``{"timestamp": (from, to), "lat": (-90, 90)}``: rows are then sorted along a curve that keeps rows near each
    other that are near in all of them, and a filter on any of them skips files.

    ``counted`` tells the rows of the table from rejected ones that are written beside it.
    """
    if max_files and cluster_by:
        raise ValueError("give max_files or cluster_by, not both")
    if cluster_by:
        # The second range key splits a value that many rows share. It is a hash of the row, and not a random
        # number, so that a task that is run again sends each row to the same place.
        whole_row = F.xxhash64(*(f.name for f in df.schema if not has_no_order(f.dataType)))
        place = F.col(cluster_by) if isinstance(cluster_by, str) else curve_place(cluster_by)
        df = df.repartitionByRange(place, whole_row).sortWithinPartitions(place)
    if max_files:
        df = df.repartition(max_files)
    seen = Observation()
    counted = F.lit(True) if counted is None else counted
    metrics = [F.count_if(counted).alias("rows"), F.count_if(~counted).alias("rejected")]
    if time_column in df.columns:
        metrics.append(cutoff_metric(time_column))
    writer = df.observe(seen, *metrics).write.mode("overwrite")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    # A query that turns out to be empty may finish without any task to observe.
    got = seen.get
    return WriteReport(
        path, got.get("rows") or 0, cutoff_text(got.get("cutoff_micros")), got.get("rejected") or 0
    )
