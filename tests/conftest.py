import pytest

from riskloom.session import build_session


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4, "riskloom-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
