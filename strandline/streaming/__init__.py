"""Structured Streaming sinks, stream dedup and supervision."""

from strandline.streaming.dedup import first_within_watermark, first_within_watermark_salted
from strandline.streaming.progress import ProgressTable, consumer_lag, progress_checks, read_progress, source_offsets
from strandline.streaming.sinks import (
    PARTS_DEPTH,
    compact_parts,
    read_compacted,
    read_parts,
    stream_append,
    stream_parts,
)
from strandline.streaming.supervise import QueryOutcome, watch

__all__ = [
    "PARTS_DEPTH",
    "ProgressTable",
    "QueryOutcome",
    "compact_parts",
    "consumer_lag",
    "first_within_watermark",
    "first_within_watermark_salted",
    "progress_checks",
    "read_compacted",
    "read_parts",
    "read_progress",
    "source_offsets",
    "stream_append",
    "stream_parts",
    "watch",
]
