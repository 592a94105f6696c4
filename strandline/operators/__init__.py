"""DataFrame to DataFrame transforms. Each serves batch and streaming input unless it says otherwise."""

from strandline.operators.dedup import keep_one
from strandline.operators.envelope import envelope
from strandline.operators.handoff import after, cutoff_of, keep_new, union_parts, up_to
from strandline.operators.parse import flatten, parse, screen, to_silver

__all__ = [
    "after",
    "cutoff_of",
    "envelope",
    "flatten",
    "keep_new",
    "keep_one",
    "parse",
    "screen",
    "to_silver",
    "union_parts",
    "up_to",
]
