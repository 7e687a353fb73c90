import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from recoflow.session import build_session

    s = build_session("local[4]", app_name="recoflow-tests", shuffle_partitions=8,
                      extra_conf={"spark.ui.enabled": "false",
                                  "spark.ui.showConsoleProgress": "false",
                                  "spark.driver.memory": "6g"})
    s.sparkContext.setLogLevel("ERROR")
    # Tests own their checkpoint folder; on a cluster spark.checkpoint.dir names it.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="recoflow-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
