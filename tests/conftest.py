import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
from thermocline.session import RUN_ROWS_CONF, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", RUN_ROWS_CONF: "16"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
