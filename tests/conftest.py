import pytest

from tastegraph.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(partitions=4, memory="6g")


TRAIN = [
    (1, 10, 5.0), (1, 11, 3.0), (1, 12, 4.0),
    (2, 10, 4.0), (2, 11, 2.0), (2, 12, 5.0), (2, 13, 3.0),
    (3, 10, 1.0), (3, 11, 5.0), (3, 13, 4.0),
    (4, 11, 4.0), (4, 12, 2.0), (4, 13, 5.0),
]
TEST = [(1, 13, 4.0), (3, 12, 2.0), (4, 10, 1.0), (9, 10, 3.0)]
SCHEMA = "user long, item long, rating double"


@pytest.fixture(scope="session")
def train(spark):
    return spark.createDataFrame(TRAIN, SCHEMA)


@pytest.fixture(scope="session")
def test_pairs(spark):
    return spark.createDataFrame(TEST, SCHEMA)
