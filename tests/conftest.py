import pytest

from ridecells.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.maxMetadataStringLength": "10000",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Sorted plain tuples of a frame, with the columns in the given order."""
    def read(frame, *columns):
        picked = frame.select(*columns) if columns else frame
        return sorted(tuple(r) for r in picked.collect())
    return read
