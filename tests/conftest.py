import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for folder in (ROOT, os.path.join(ROOT, "tests")):
    if folder not in sys.path:
        sys.path.insert(0, folder)

from sluice.schemas import TOPIC_RECORD  # noqa: E402
from sluice.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[*]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            # Tests count the plans that were run since; the session's list ends at 1,000 by default.
            "spark.sql.ui.retainedExecutions": "100000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def records(spark):
    """Topic records from texts: ``records(["{}", ...], topic=..., partition=..., first=...)``."""

    def make(values, topic="t", partition=0, first=0):
        rows = [(topic, partition, first + i, None, None, v) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, TOPIC_RECORD)

    return make
