import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from clientele import get_session
    ckpt = tempfile.mkdtemp(prefix="clientele-test-ckpt-")
    s = get_session("local[4]", shuffle_partitions=8, conf={"spark.checkpoint.dir": ckpt,
                                                             "spark.driver.memory": "4g"})
    yield s
    s.stop()
