from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    import os

    from docmill.session import build

    os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (str(ROOT), os.environ.get("PYTHONPATH", "")) if p)
    session = build(
        "local[4]", 4, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
