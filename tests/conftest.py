import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = os.environ.get("WINBACK_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from winback.session import local_session
    s = local_session(cores="*", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


@pytest.fixture(scope="session")
def duck(sf_dir):
    from tests.oracle_compare import duck as make
    return make(sf_dir)


@pytest.fixture(scope="session", autouse=True)
def few_rounds():
    """The registered queries fit 1,000 and up to 180 rounds; that takes minutes and
    changes no row, so tests of whole queries run them with a few."""
    from winback.operators import boosting, propensity
    before = propensity.PRODUCT_MODEL["rounds"], boosting.MAX_ROUNDS, boosting.PATIENCE
    propensity.PRODUCT_MODEL["rounds"], boosting.MAX_ROUNDS, boosting.PATIENCE = 60, 12, 3
    yield
    propensity.PRODUCT_MODEL["rounds"], boosting.MAX_ROUNDS, boosting.PATIENCE = before
