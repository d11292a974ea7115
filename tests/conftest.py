import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from marquee.session import get_session
    ck = tempfile.mkdtemp(prefix="marquee-test-ckpt-")
    s = get_session("local[4]", app="marquee-tests", shuffle_partitions=8,
                    conf={"spark.checkpoint.dir": ck})
    yield s
    s.stop()


@pytest.fixture
def tmp_out(tmp_path):
    return str(tmp_path)
