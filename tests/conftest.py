from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sensorloom import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


T0 = datetime(2024, 1, 1)


def at(steps: float, step: int = 900, start: datetime = T0) -> datetime:
    return start + timedelta(seconds=steps * step)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
