import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tierlake.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", shuffle_partitions=4,
                      extra={"spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()
