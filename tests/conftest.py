import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from strata.session import get_session
    s = get_session("strata-tests", master="local[4]", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield s
    s.stop()
