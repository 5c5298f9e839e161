import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from precinct.session import local_session

    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = local_session(
        "*",
        shuffle_partitions=8,
        app_name="precinct-tests",
        extra_conf={"spark.checkpoint.dir": ckpt},
    )
    yield s
    s.stop()
