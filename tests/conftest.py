import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
# Spark's Python workers import the package and the fakes too
os.environ["PYTHONPATH"] = os.pathsep.join(
    [os.path.dirname(HERE), HERE, os.environ.get("PYTHONPATH", "")]
)

from zilverspoor.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "tests",
        spark__master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__sql__warehouse__dir=str(warehouse),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows(spark):
    """Collect as sorted tuples, NULLs first."""

    def collect(df):
        found = [tuple(r) for r in df.collect()]
        return sorted(found, key=lambda r: [(v is not None, str(v)) for v in r])

    return collect
