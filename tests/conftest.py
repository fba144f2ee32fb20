import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from placewell.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", {
        "spark.sql.shuffle.partitions": "4",
        "spark.default.parallelism": "2",
        "spark.driver.memory": "4g",
        "spark.ui.enabled": "false",
        "spark.sql.maxMetadataStringLength": "10000",
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    # a space, as stored paths may hold one
    return str(tmp_path / f"run {uuid.uuid4().hex[:6]}")


@pytest.fixture
def database():
    return f"clean_{uuid.uuid4().hex[:8]}"
