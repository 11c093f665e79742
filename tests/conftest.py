import pytest

from tallyhouse.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="4", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    from tallyhouse.plans.catalog import workspace

    return workspace(spark, SMALL)
