import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plyscope.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="plyscope-test-ckpt-")
    s = build_session(master="local[4]", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="plyscope-test-")
