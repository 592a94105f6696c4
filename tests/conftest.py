from __future__ import annotations

import os
import sys
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strandline import ENVELOPE, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def at(seconds: float) -> datetime:
    return datetime.fromtimestamp(1_700_000_000 + seconds, tz=timezone.utc)


@pytest.fixture
def envelope_of(spark):
    """Envelope rows from (topic, seconds after a fixed time or None, text)."""

    def build(rows):
        return spark.createDataFrame(
            [(topic, None if s is None else at(s), text) for topic, s, text in rows], ENVELOPE
        )

    return build


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
