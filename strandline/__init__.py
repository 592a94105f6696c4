"""strandline: raw JSON messages to typed tables, as Spark batch and streaming jobs."""

from strandline.contracts import AIR_QUALITY, CONDITIONS, ENVELOPE, Feed, SilverColumn
from strandline.session import build_session

__all__ = ["AIR_QUALITY", "CONDITIONS", "ENVELOPE", "Feed", "SilverColumn", "build_session"]
