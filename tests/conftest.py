import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from martlake.session import build_session
    s = build_session(os.environ.get("MARTLAKE_TEST_MASTER", "local[4]"), shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="martlake-test-ckpt-")})
    from martlake.session import checkpoint_dir
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL
