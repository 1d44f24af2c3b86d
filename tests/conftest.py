import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from manifestqc.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="manifestqc-tests")
    yield s


def rows(df, *cols, order=None):
    """Collect as list of tuples (sorted) for assertions."""
    sel = df.select(*cols) if cols else df
    out = [tuple(r) for r in sel.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t)) if order is None else out
