import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from headway import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    made = session.build("headway-tests", cores="8", shuffle_partitions=4)
    yield made
    made.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
