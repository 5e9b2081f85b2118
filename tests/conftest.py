import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from stationlake.session import get_spark

    s = get_spark("local[4]", 4, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="sl-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="sl-test-")


@pytest.fixture(scope="session")
def small_readings(spark):
    from stationlake.sources.fixtures import readings

    return readings(spark, SF_SMALL).cache()
