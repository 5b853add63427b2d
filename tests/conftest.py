import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from feedloom.session import build_session

    session = build_session(
        "tests",
        "local[8]",
        {
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
