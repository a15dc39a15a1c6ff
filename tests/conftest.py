import pytest

from seriesloom.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        app="seriesloom-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
