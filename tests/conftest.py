import pytest

from stintlab.config import Scale
from stintlab.session import get_spark

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests",
        master="local[8]",
        settings={
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def tight():
    """Limits so low that every large-scale path is taken on small data."""
    return Scale(
        small_bytes=0, hot_rows=20, block_rows=7, broadcast_rows=2, broadcast_bytes=64 << 20,
    )


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)
