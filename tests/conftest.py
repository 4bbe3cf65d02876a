import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from regpanel.session import build_session
    scratch = tempfile.mkdtemp(prefix="regpanel-test-", dir="/tmp")
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="regpanel-tests",
                      scratch_dir=scratch, extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (order-insensitive comparison helper)."""
    cols = cols or df.columns
    return sorted((tuple(r) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))
