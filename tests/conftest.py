import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from smelter.session import build_session

    session = build_session("smelter-tests", "local[8]", {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.driver.extraJavaOptions": "-Dlog4j2.level=ERROR",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
