import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))
os.environ["PYTHONPATH"] = f"{Path(__file__).parent.parent}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from recordloom.session import build_session

    session = build_session(
        "tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "3g", "spark.default.parallelism": "4"}
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
