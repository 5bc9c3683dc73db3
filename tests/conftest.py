import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from cartpulse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "cartpulse-tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp")})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
