import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tidemark-tests",
        master="local[8]",
        shuffle_partitions=4,
        extra={
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
