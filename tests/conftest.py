import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quayside.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, driver_memory="8g")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (NULL-safe sort)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((v is None, v) for v in t))
