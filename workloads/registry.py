"""Name to query and SQL."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from strandline.session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def with_folder(spark: SparkSession) -> SparkSession:
    """The session, with a checkpoint folder of its own if nobody has set one and all executors are in this process."""
    unset = not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    if unset and re.match(r"local(\[|$)", spark.sparkContext.master):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strandline-"))
    return spark


def query(sql: str | None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that gives the same rows."""

    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(with_folder(pin_utc(spark)), sf_dir.rstrip("/"))

        QUERIES[function.__name__] = run
        if sql is not None:
            SQL[function.__name__] = sql
        return run

    return register
