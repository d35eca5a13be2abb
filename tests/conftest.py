import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from urbanlens.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", app_name="urbanlens-tests", shuffle_partitions=8)
    yield s


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never cleaned up by the tests)."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def rows(df, *cols):
    """Collect as sorted tuples (optionally selecting columns)."""
    if cols:
        df = df.select(*cols)
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
