import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from adlens.session import get_session
    s = get_session(app="adlens-tests", master="local[4]",
                    conf={"spark.sql.shuffle.partitions": "8"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.exists(f"{SF_SMALL}/lineitem.parquet"):
        pytest.skip("test tables not present")
    return SF_SMALL
