import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from immolens.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=8, app_name="immolens-tests")
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="immolens-test-")


def rows(df, *cols):
    """Collected rows as tuples (optionally of some columns)."""
    if cols:
        df = df.select(*cols)
    return [tuple(r) for r in df.collect()]
