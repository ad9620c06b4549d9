import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from sparkfold.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_uri(spark, tmp_path):
    return str(tmp_path)
