import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gridledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4, app_name="gridledger-tests",
                      extra={"spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    # tests are the one place the checkpoint folder is set here (it is unset in local runs)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gridledger-test-ckpt-"))
    yield s
    s.stop()


def rows(df, *cols):
    """Collect selected columns as a sorted list of tuples (tests only)."""
    cols = cols or df.columns
    return sorted(tuple(r) for r in df.select(*cols).collect())
