import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from techmine.session import build_session
    s = build_session("local[4]", app="techmine-tests", shuffle_partitions=8)
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted plain tuples of a DataFrame (optionally a column subset)."""
    if cols:
        df = df.select(*cols)
    return sorted(tuple(r) for r in df.collect())
