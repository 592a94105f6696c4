"""Bronze to silver, once, as a batch."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.contracts import Feed
from strandline.functions import utc_day
from strandline.operators.dedup import keep_one
from strandline.operators.handoff import positions_of
from strandline.operators.parse import LOG_KEY, SILVER, flatten, missing_values, parse, routed, to_silver
from strandline.sinks.files import WriteReport, batch_overwrite
from strandline.sources.files import read_files


def silver_rows(
    bronze: DataFrame,
    feed: Feed,
    keys: Sequence[str] = ("timestamp",),
    raw_dedup: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Parsed rows, one per key (A1).

    Of the rows of one key the one with the most values wins, then the smallest (H5). ``keys`` may name envelope
    columns that silver does not have, such as ``topic``, ``partition`` and ``offset`` (H2); those of ``keep``
    it does have.

    ``raw_dedup`` removes duplicates before the parse. That saves parsing copies, and fits where copies are
    byte-identical, as after a replay; with different texts under one key the first text wins, parsed or not.
    """
    if raw_dedup:
        return to_silver(keep_one(bronze, keys), feed, keep)
    parsed = parse(bronze, feed)
    unseen = [k for k in keys if k != "timestamp" and k not in keep]
    flat = flatten(parsed, feed, *keep, *(F.col(k).alias(f"_key_{k}") for k in unseen))
    stored = [f"_key_{k}" if k in unseen else k for k in keys]
    return keep_one(flat, stored, [missing_values(feed)]).drop(*(f"_key_{k}" for k in unseen))


def routed_rows(
    bronze: DataFrame,
    feed: Feed,
    keys: Sequence[str] = ("timestamp",),
    earliest: str | None = None,
    latest: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """:func:`silver_rows` and the rejected rows beside them, by ``part``.

    Rejected rows take no part in the choice of a key's survivor: each different text stays, once.
    """
    kept = list(dict.fromkeys([*keep, *(k for k in keys if k != "timestamp")]))
    rows = routed(bronze, feed, earliest, latest, kept)
    return keep_one(rows, [*keys, "part", "raw"], [missing_values(feed)])


def backfill(
    bronze: DataFrame,
    feed: Feed,
    path: str,
    keys: Sequence[str] = ("timestamp",),
    max_files: int | None = None,
    raw_dedup: bool = False,
    cluster: bool = False,
    by_day: bool = False,
    keep: Sequence[str] = (),
    quarantine: bool = False,
    earliest: str | None = None,
    latest: str | None = None,
) -> WriteReport:
    """Write silver from all of bronze and return what the stream has to know: cutoff and positions (T5, H1, K3).

    The cutoff is the largest ``timestamp`` that was really loaded, not the time the job ended. So rows that
    reached bronze during the job are left to the stream, and none falls between. With the columns of ``LOG_KEY``
    in ``keep`` the report also has the largest offset of each partition of the log, which is the exact cutoff. They are
    read back from what was written if ``LOG_KEY`` is the key; other keys may drop the row of the largest offset, so that
    bronze is scanned for it once more.

    * ``cluster`` sorts the files by ``timestamp``, for one more shuffle.
    * ``by_day`` writes ``day=<yyyy-mm-dd>`` directories, so a stream that adds by key lists and reads the days
      of its own rows only, a late row's day among them.
    * ``quarantine`` writes silver to ``part=silver`` and the rejected rows, malformed or not between ``earliest`` and
      ``latest``, with their text to ``part=quarantine`` below ``path``, in the same pass.
    """
    if quarantine:
        rows = routed_rows(bronze, feed, keys, earliest, latest, keep)
    else:
        rows = silver_rows(bronze, feed, keys, raw_dedup, keep)
    levels = ["part"] * quarantine + ["day"] * by_day
    if by_day:
        # After the keyed shuffle every task holds rows of every day. AQE splits a large day by size.
        rows = rows.withColumn("day", utc_day(F.col("timestamp"))).hint("rebalance", F.col("day"))
    report = batch_overwrite(
        rows,
        path,
        max_files,
        partition_by=levels or None,
        cluster_by="timestamp" if cluster else None,
        counted=F.col("part") == SILVER if quarantine else None,
    )
    if not set(LOG_KEY) <= set(keep):
        return report
    if set(LOG_KEY) <= set(keys):
        # No place in the log is lost to another one, so what was written tells. Only the three columns are read.
        written = read_files(bronze.sparkSession, path, bronze.select(*LOG_KEY).schema, depth=len(levels), missing_ok=True)
    else:
        written = bronze
    return replace(report, positions=positions_of(written))
