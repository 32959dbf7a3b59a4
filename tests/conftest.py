import pytest

from checks.compare import connect, session
from checks.fixtures import Fixtures

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session("4")
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return spark


@pytest.fixture(scope="session")
def con():
    return connect(SF_DIR)


@pytest.fixture(scope="session")
def fx(spark):
    return Fixtures(spark, SF_DIR)
