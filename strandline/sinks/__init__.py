"""Batch sinks, message publishing and external tables."""

from strandline.sinks.buckets import buckets_for, keep_new_bucketed, write_bucketed
from strandline.sinks.files import WriteReport, batch_overwrite, curve_place
from strandline.sinks.messages import publish_json, send_to_topic
from strandline.sinks.tables import (
    ensure_namespace,
    register_external,
    register_union,
    register_versioned,
    register_view,
    run_sql,
)

__all__ = [
    "WriteReport",
    "batch_overwrite",
    "buckets_for",
    "curve_place",
    "ensure_namespace",
    "keep_new_bucketed",
    "publish_json",
    "register_external",
    "register_union",
    "register_versioned",
    "register_view",
    "run_sql",
    "send_to_topic",
    "write_bucketed",
]
