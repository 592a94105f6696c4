"""Configured lists as tables: literal rows that queries meet."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def listed(spark: SparkSession, schema: str, rows: Sequence[tuple]) -> DataFrame:
    """A configured list as literal rows of the plan.

    Spark knows their size, so its own threshold decides whether they are broadcast.
    """
    fields = StructType.fromDDL(schema).fields
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    kinds = to_arrow_schema(StructType(fields))
    arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds.types, strict=True)]
    return spark.createDataFrame(pa.table(arrays, schema=kinds), schema=StructType(fields))


def expected_rows(spark: SparkSession, column: str, names: Sequence[str]) -> DataFrame:
    """A list of names as a table of one column."""
    return listed(spark, f"{column} STRING", [(n,) for n in names])
