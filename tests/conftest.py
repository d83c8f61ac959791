import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from autopulse.session import local_session

    s = local_session(cores=4, shuffle_partitions=4, app="autopulse-tests", driver_memory="4g")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted plain tuples of a frame (optionally a column subset)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
