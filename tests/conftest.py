import pytest

from footfall.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "footfall-tests", "6g")
    yield session
    session.stop()
