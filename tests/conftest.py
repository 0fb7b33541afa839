import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowspark.session import tune  # noqa: E402
from tests.compare import TESTDATA, make_session, oracle  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return tune(make_session())


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def duck(sf_dir):
    return oracle(sf_dir)
