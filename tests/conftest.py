import pytest

from oreflow.session import local_session


@pytest.fixture(scope="session")
def spark():
    spark = local_session("tests", cores="8", shuffle_partitions=4)
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def rows(spark):
    """Make a DataFrame from rows and a DDL schema."""
    return lambda data, ddl: spark.createDataFrame(data, ddl)
