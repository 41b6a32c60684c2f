import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import get_spark
    s = get_spark("local[4]", "ledgerline-tests", shuffle_partitions=4,
                  extra={"spark.default.parallelism": "4"})
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ll-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"
