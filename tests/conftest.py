import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from fulfilq.session import get_spark

    ckpt = tempfile.mkdtemp(prefix="fulfilq-test-ckpt-")
    s = get_spark(
        "local[4]",
        app_name="fulfilq-tests",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g", "spark.checkpoint.dir": ckpt},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="fulfilq-test-")
