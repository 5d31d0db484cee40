import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from cellmart.session import get_session
    s = get_session(app="cellmart-tests", master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


def rows(df, order=None):
    """Collected rows as dicts (sorted by ``order`` or by all columns)."""
    out = [r.asDict() for r in df.collect()]
    keys = order or list(df.columns)
    return sorted(out, key=lambda r: tuple((r[k] is None, str(r[k])) for k in keys))
