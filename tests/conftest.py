import pytest

from quarrymill.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests")


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
