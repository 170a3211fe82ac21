import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tillstream.session import build_session
    session = build_session("tests", "local[8]", {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def plan_of():
    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()
    return text
