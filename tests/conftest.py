import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from churnlens.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark(app="churnlens-tests", master="local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
