import pytest

from scanlake.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4)
    session.sparkContext.setLogLevel("ERROR")
    return session
