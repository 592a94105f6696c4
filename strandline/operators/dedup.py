"""Keyed distinct with a defined survivor (A1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def has_no_order(data_type: T.DataType) -> bool:
    """True for types that can be neither compared nor hashed: maps, variants and what contains them."""
    if isinstance(data_type, (T.MapType, T.VariantType)):
        return True
    if isinstance(data_type, T.ArrayType):
        return has_no_order(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(has_no_order(f.dataType) for f in data_type.fields)
    return False


def keep_one(
    df: DataFrame,
    keys: Sequence[str] = ("timestamp",),
    order_by: Sequence[str | Column] = (),
    keep: str = "first",
) -> DataFrame:
    """One row per key, batch only (A1).

    The survivor is the first (or last) row by ``order_by``, then by all remaining columns. So the result
    does not depend on task order, and a task that runs again after a lost executor gives the same rows
    (H3). NULL sorts before values. Rows with a NULL key count as one group (H13).

    It is a plain min/max aggregate over a struct: each task first reduces its own rows, so a key that
    holds a third of all rows crosses the shuffle once per task and no group is ever gathered.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', got {keep!r}")
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest and not order_by:
        return df.distinct()

    if all(isinstance(c, str) and c in rest for c in order_by):
        lead = []
        trail = [*order_by, *(c for c in rest if c not in order_by)]
    else:
        # Computed values come before the columns, in the caller's priority.
        lead = [(F.col(c) if isinstance(c, str) else c).alias(f"_order{i}") for i, c in enumerate(order_by)]
        trail = rest

    unordered = [c for c in trail if has_no_order(df.schema[c].dataType)]
    if unordered:
        # Maps and variants can not be compared; their JSON text breaks the tie instead.
        ranking = F.struct(
            *lead,
            *(c for c in trail if c not in unordered),
            *(F.to_json(F.struct(c)).alias(f"_text_{c}") for c in unordered),
        )
        pick = F.min_by if keep == "first" else F.max_by
        survivor = pick(F.struct(*rest), ranking)
    else:
        survivor = (F.min if keep == "first" else F.max)(F.struct(*lead, *trail))

    best = df.groupBy(*keys).agg(survivor.alias("_best"))
    return best.select(
        *(F.col(c) if c in keys else F.col("_best").getField(c).alias(c) for c in df.columns)
    )
