import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from lingolake.session import session

    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    folder = tempfile.mkdtemp(prefix="lingolake-tests-")
    out = session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": f"file://{folder}", "spark.sql.warehouse.dir": f"{folder}/warehouse", "spark.driver.memory": "4g"})
    out.sparkContext.setLogLevel("ERROR")
    yield out
    out.stop()
