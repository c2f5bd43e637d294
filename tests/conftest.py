import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricelake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    s = build_session("local[4]", app="pricelake-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt,
                             "spark.sql.autoBroadcastJoinThreshold": "-1"})
    yield s
    s.stop()
