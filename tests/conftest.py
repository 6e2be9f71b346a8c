import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from siftworks.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4, memory="8g")


def rows(df, *columns):
    """The rows of ``df`` as a sorted list of tuples."""
    out = df.select(*columns) if columns else df
    return sorted(tuple(r) for r in out.collect())
