import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from netsieve.session import get_session
    extra = {"spark.ui.showConsoleProgress": "false"}
    s = get_session("local[*]", app="netsieve-tests", shuffle_partitions=8, extra=extra)
    if not s.conf.get("spark.checkpoint.dir", None):          # tests only: set when unset
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="netsieve-test-ckpt-"))
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="netsieve-test-")
