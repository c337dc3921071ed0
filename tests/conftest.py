import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from concord.session import local_session, ship_package

    s = local_session(4, 4)
    ship_package(s)
    return s


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
