"""Column helpers. All are compositions of built-in functions."""

from strandline.functions.payload import first_element, json_bytes, json_text, utf8_text
from strandline.functions.times import (
    age_seconds,
    from_epoch_seconds,
    instant,
    iso_text,
    iso_utc,
    seconds,
    utc_day,
    within,
)

__all__ = [
    "age_seconds",
    "first_element",
    "from_epoch_seconds",
    "instant",
    "iso_text",
    "iso_utc",
    "json_bytes",
    "json_text",
    "seconds",
    "utc_day",
    "utf8_text",
    "within",
]
