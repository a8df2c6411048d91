import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from larkspur import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    conf = {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
    }
    session = build_session("tests", "local[8]", **conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
