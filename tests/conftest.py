import pytest

from tidemark.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = build_session(
        "tests",
        master="local[8]",
        shuffle_partitions=4,
        extra={"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": f"{folder}/warehouse"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
