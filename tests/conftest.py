import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from larder.session import get_session

    scratch = tempfile.mkdtemp(prefix="larder-test-")
    s = get_session("larder-tests", master="local[4]", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": f"{scratch}/ckpt", "spark.local.dir": scratch})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tmpdir_session():
    return tempfile.mkdtemp(prefix="larder-test-out-")
