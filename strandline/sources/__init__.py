"""Tables and streams to read from. Locations are parameters, any Hadoop file system URI will do."""

from strandline.sources.files import (
    file_inventory,
    glob_of,
    read_bronze,
    read_files,
    read_landed_json,
    recent_days,
    stream_bronze,
    stream_days,
    stream_files,
    stream_landed_json,
)
from strandline.sources.topics import (
    end_offsets,
    read_topic,
    read_topics,
    reported_offsets,
    scan_topics,
    topic_options,
)

__all__ = [
    "end_offsets",
    "file_inventory",
    "glob_of",
    "read_bronze",
    "read_files",
    "read_landed_json",
    "read_topic",
    "read_topics",
    "recent_days",
    "reported_offsets",
    "scan_topics",
    "stream_bronze",
    "stream_days",
    "stream_files",
    "stream_landed_json",
    "topic_options",
]
