import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from lastmile.session import get_session

    session = get_session(
        app="lastmile-tests",
        master="local[*]",
        shuffle_partitions=8,
        extra_conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="lastmile-wh-")},
    )
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="lastmile-test-")


def same_rows(a, b) -> bool:
    """Multiset equality of two DataFrames with the same columns (NULLs compare equal)."""
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
