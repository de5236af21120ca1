import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from adtally.session import build  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build(
        "tests", "local[4]",
        # Frames are tiny here; compiling code for them takes longer than running them.
        **{"spark.sql.shuffle.partitions": "2", "spark.driver.memory": "4g",
           "spark.sql.codegen.wholeStage": "false", "spark.python.sql.dataFrameDebugging.enabled": "false",
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def frame(spark):
    """A frame from tuples and a DDL layout."""
    def make(rows, layout):
        return spark.createDataFrame(rows, layout)

    return make


def values(df, *columns):
    """Sorted tuples of a small result."""
    picked = df.select(*columns) if columns else df
    return sorted(tuple(r) for r in picked.collect())
