import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from emporia.plans.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("EMPORIA_SCRATCH", tempfile.mkdtemp(prefix="emporia-test-"))
    s = local_session("4", shuffle_partitions=8, app="emporia-tests")
    yield s


def rows(df, order=None):
    """Collect as sorted list of dicts (order-insensitive comparisons)."""
    out = [r.asDict() for r in df.collect()]
    return sorted(out, key=lambda d: [(v is None, str(v)) for v in (d[k] for k in (order or sorted(d)))])
