import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mercato.session import build_session, checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="mercato-tests-")
    s = build_session(master="local[*]", shuffle_partitions=8, app_name="mercato-tests",
                      extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                             "spark.driver.memory": "8g"})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="mercato-run-")
