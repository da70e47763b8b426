import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cartmill.session import build_session

    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path):
    from cartmill.sources.lake import Lake

    return Lake(str(tmp_path))
