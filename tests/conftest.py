import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from regain.plans.session import local_session

    return local_session(4, memory="6g", name="regain-tests")


@pytest.fixture(scope="session")
def keep(spark):
    from regain.plans.store import Scratch

    return Scratch(spark).keep
