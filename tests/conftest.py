import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventrank.sources.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=4)


@pytest.fixture
def folder(tmp_path):
    """A new folder for each test."""
    return str(tmp_path / "data")
