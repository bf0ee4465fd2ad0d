import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from visitlens.session import get_session

    s = get_session("local[*]", app_name="visitlens-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect ``cols`` (default: all) as a list of tuples, in row order."""
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
