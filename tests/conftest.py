import pytest

from tests.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(cpus="4", spark__sql__shuffle__partitions="4")
