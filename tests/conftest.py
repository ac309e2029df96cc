import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--conf spark.ui.showConsoleProgress=false pyspark-shell")


@pytest.fixture(scope="session")
def spark():
    from pilotlamp.session import build_session, drop_tables

    session = build_session("tests", "local[8]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_tables(session)
    session.stop()
