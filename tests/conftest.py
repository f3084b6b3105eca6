import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tastegraph.session import build_session

    session = build_session(
        "local[4]", 4, **{"spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL


@pytest.fixture
def ratings_of(spark):
    from tastegraph.sources import RATINGS

    return lambda rows: spark.createDataFrame(rows, RATINGS)
