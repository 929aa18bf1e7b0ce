import pytest

from lakeline.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}", "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as sorted tuples."""
    return lambda df: sorted(map(tuple, df.collect()), key=repr)
