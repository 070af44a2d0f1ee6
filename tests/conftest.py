import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pricelake.session import get_spark
    s = get_spark("local[4]", app="pricelake-tests", shuffle_partitions=4,
                  extra={"spark.driver.memory": "6g"})
    s.sparkContext.setLogLevel("ERROR")
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pricelake-test-ckpt-"))
    yield s


@pytest.fixture()
def lake(spark, tmp_path):
    """A fresh lake root for one test (tests only; jobs use the shared root)."""
    return str(tmp_path / "lake")


SF = "/root/testdata/sf0.001"
