import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from shopstream.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="shopstream-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect selected columns as sorted tuples."""
    cols = cols or tuple(df.columns)
    key = lambda t: [(v is None, "" if v is None else v) for v in t]
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)
