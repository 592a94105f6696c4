"""Text, JSON and array helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utf8_text(value: Column, replace_invalid: bool = False) -> Column:
    """Message bytes as text (F1). With ``replace_invalid`` bad sequences become U+FFFD."""
    text = value.cast("string")
    return F.make_valid_utf8(text) if replace_invalid else text


def json_text(*columns: Column | str) -> Column:
    """The columns as one JSON object. NULL fields are left out."""
    return F.to_json(F.struct(*columns))


def json_bytes(*columns: Column | str) -> Column:
    """The columns as one JSON object in UTF-8 bytes."""
    return F.encode(json_text(*columns), "UTF-8")


def first_element(array: Column) -> Column:
    """First element, NULL for an empty or NULL array.

    ``array[0]`` would raise on an empty array under ANSI (H4).
    """
    return F.get(array, F.lit(0))
