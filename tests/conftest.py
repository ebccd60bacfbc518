import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rebasket.plans.retail import shop  # noqa: E402
from rebasket.session import local_session  # noqa: E402

TINY = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny(spark):
    return shop(spark, TINY)


@pytest.fixture(scope="session")
def small(spark):
    return shop(spark, SMALL)
