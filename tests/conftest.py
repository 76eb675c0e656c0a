from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from gridloom.session import local_session

    folder = tmp_path_factory.mktemp("scratch")
    session = local_session(4, 4, **{"spark.checkpoint.dir": f"file://{folder}", "spark.sql.warehouse.dir": f"file://{folder}/warehouse", "spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
