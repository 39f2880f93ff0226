from __future__ import annotations

import pytest

from tidewatch.session import get_session


def make_session():
    spark = get_session(
        "tidewatch-tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__sql__autoBroadcastJoinThreshold="10MB",
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    yield session
    session.stop()
