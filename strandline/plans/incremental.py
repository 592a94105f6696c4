"""Bronze to silver, ongoing, as a stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from strandline.contracts import TRIGGER_INTERVAL, Feed
from strandline.operators.handoff import after, after_positions
from strandline.operators.intervals import outside_ranges
from strandline.operators.parse import missing_values, routed, to_silver
from strandline.plans.silver import silver_schema
from strandline.sources.files import read_files
from strandline.streaming.sinks import days_path, stream_parts


def incremental(
    bronze: DataFrame,
    feed: Feed,
    path: str,
    checkpoint: str,
    cutoff: str | None = None,
    every: str | None = TRIGGER_INTERVAL,
    new_keys: Sequence[str] = (),
    backfill_path: str | None = None,
    name: str | None = None,
    positions: Mapping[tuple[str, int], int] | None = None,
    keep: Sequence[str] = (),
    backfill_by_day: bool = False,
    time_bounded: bool | None = None,
    quarantine: bool = False,
    earliest: str | None = None,
    latest: str | None = None,
    ranges: DataFrame | None = None,
    sketch: str | None = None,
) -> StreamingQuery:
    """Parse what arrives into the stream half of silver.

    By place in the log: rows behind ``positions``, as the backfill reports them. No shuffle, and exact where the history has no
    holes. Else rows outside of ``ranges``, what ``operators.intervals.offset_ranges`` says of the history: exact for any.

    By time: rows after ``cutoff``, no shuffle. Exact where times strictly rise.

    By key: ``new_keys``, columns of silver or of ``keep``, with ``backfill_path`` and no cutoff leave out what
    silver already holds. It costs a shuffle of the micro-batch and a read of silver's key columns, and is
    exact for any order of arrival, replays included (H1, T11). Within a micro-batch the fullest row of a key
    wins, as in the backfill (H5). A ``backfill_path`` without files raises: leave it out if there was none.
    ``time_bounded`` says that a key determines its row's ``timestamp``, as a place in the log does. Then only the
    days and times of the micro-batch are read, from both halves; give ``backfill_by_day`` if that was written so.

    ``sketch`` is for keys that do not say what the time is: a location for sketches of the stream's parts, so that only those
    that may hold a key of the micro-batch are read. The keys of ``backfill_path`` are read whole all the same.

    ``quarantine`` writes to ``part=silver`` and ``part=quarantine`` below ``path``, as in the backfill. Then
    ``backfill_path`` is the whole location of a backfill with quarantine, too.
    """
    spark, loaded = bronze.sparkSession, None
    extra = list(dict.fromkeys([*keep, "topic"] if quarantine else keep))
    if new_keys and backfill_path:
        schema = silver_schema(spark, feed, extra)
        if quarantine:
            schema = schema.add("raw", "string").add("part", "string")
        base = backfill_path.rstrip("/") + "/part=*" * quarantine

        def loaded(spark, days=None):
            where = days_path(base, days) if backfill_by_day else base
            root = backfill_path if quarantine else None
            return read_files(spark, where, schema, missing_ok=days is not None, base_path=root)

        loaded(spark)  # a mistyped path fails here and not in the first micro-batch

    def prepare(rows: DataFrame) -> DataFrame:
        return routed(rows, feed, earliest, latest, keep) if quarantine else to_silver(rows, feed, keep)

    wanted = after_positions(after(bronze, cutoff), positions or {})
    if ranges is not None:
        wanted = outside_ranges(wanted, ranges)
    return stream_parts(
        wanted,
        path,
        checkpoint,
        every=every,
        new_keys=[*new_keys, "part", "raw"] if new_keys and quarantine else new_keys,
        loaded=loaded,
        order_by=[missing_values(feed)],
        prepare=prepare,
        name=name,
        time_bounded=time_bounded,
        split_by="part" if quarantine else None,
        sketch=sketch,
    )
