import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from synthcurate.session import build_session, configure  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]",
        spark__ui__enabled="false", spark__sql__shuffle__partitions="4", spark__driver__memory="3g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a DataFrame from tuples and a schema text."""
    return lambda data, schema: spark.createDataFrame(data, schema)
