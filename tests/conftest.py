import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cratelight.session import local_session

    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    path = DATA / "sf0.001"
    if not path.exists():
        pytest.skip("test tables are not here")
    return str(path)


@pytest.fixture
def cell(spark):
    """The value of one column expression over literals."""

    def value(expression):
        return spark.range(1).select(expression.alias("x")).first()["x"]

    return value
