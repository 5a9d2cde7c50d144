from __future__ import annotations

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from silverlode.session import Settings, build_session

    session = build_session(
        Settings(app_name="tests", master="local[*]", shuffle_partitions=4, driver_memory="8g")
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small() -> str:
    return SMALL


@pytest.fixture(scope="session")
def duck():
    from compare import connect

    return connect(SMALL)


def plan_of(df, mode: str = "formatted") -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )
