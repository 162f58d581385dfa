import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabulae.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, shuffle_partitions=4, app="tabulae-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp(spark):
    """A fresh local directory for raw test files."""
    return tempfile.mkdtemp(prefix="tabulae-test-")


def rows(df, order=None):
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple("" if v is None else str(v) for v in r)) if order is None else out
