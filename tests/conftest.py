import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.log.level": "ERROR",
        "spark.sql.warehouse.dir": str(work / "warehouse"), "spark.checkpoint.dir": str(work / "shared"),
        "spark.ui.showConsoleProgress": "false",
    })
    yield session
    session.stop()
