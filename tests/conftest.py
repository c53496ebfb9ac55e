import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from dimetl.session import build_session

    ckpt = tempfile.mkdtemp(prefix="dimetl-test-ckpt-")
    s = build_session(
        "local[4]",
        app_name="dimetl-tests",
        shuffle_partitions=4,
        extra_conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="dimetl-test-")
