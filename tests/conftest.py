import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from strataward.session import build_session
    from strataward.streaming.alerts import STATE_STORE

    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": "6g", "spark.sql.streaming.stateStore.providerClass": STATE_STORE},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
