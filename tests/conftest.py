import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from starmart.session import get_session
    ckpt = tempfile.mkdtemp(prefix="starmart-test-ckpt-")
    s = get_session("local[4]", app="starmart-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="starmart-test-")


def rows(df, order=None):
    """Collect as a list of dicts, sorted for stable comparison."""
    out = [r.asDict(recursive=True) for r in df.collect()]
    if order:
        out.sort(key=lambda r: tuple((r[k] is None, r[k]) for k in order))
    return out
