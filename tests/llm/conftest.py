import pytest

from corpusflow import session


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    session.prepare(spark)
