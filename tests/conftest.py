import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from leafmill.session import build_session  # noqa: E402

_BASE = tempfile.mkdtemp(prefix="leafmill-tests-")
# Started before the test modules load: they hold column expressions.
_SESSION = build_session(
    "tests",
    "local[8]",
    **{
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": f"{_BASE}/warehouse",
        "spark.checkpoint.dir": f"{_BASE}/scratch",
        "spark.ui.showConsoleProgress": "false",
    },
)
_SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield _SESSION
    _SESSION.stop()
