import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tripkit.session import get_spark
    s = get_spark("local[2]", app="tripkit-tests", shuffle_partitions=4,
                  extra={"spark.local.dir": tempfile.mkdtemp(prefix="tripkit-test-local-")})
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tripkit-test-")


SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
