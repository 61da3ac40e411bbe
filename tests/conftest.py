import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stationtide.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Small DataFrame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
