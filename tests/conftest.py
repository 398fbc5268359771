import pytest

from lendspark.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, spark__sql__shuffle__partitions="4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def loans(spark):
    from checks import fixtures

    return fixtures.loans(spark, SMALL).persist()
