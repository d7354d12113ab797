from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tickloom.session import local_session  # noqa: E402

BAR_SCHEMA = (
    "instrument string, ts timestamp_ntz, open double, high double, low double, close double, "
    "volume double"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = local_session(8, app="tests", **{"spark.checkpoint.dir": str(folder)})
    yield session
    session.stop()


@pytest.fixture
def make_bars(spark):
    """Bars from (instrument, time text, value) with the value in every column."""

    def make(rows):
        return spark.createDataFrame(
            [(i, datetime.fromisoformat(t), v, v, v, v, v) for i, t, v in rows], BAR_SCHEMA
        )

    return make
