import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from treadle.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", 4, **{
        "spark.driver.memory": "4g", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""
    def read(df, *columns):
        out = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in out.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
    return read
