import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from recordforge.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", **{"spark.sql.shuffle.partitions": "8"})
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"
