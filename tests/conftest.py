import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lacuna.session import local_session

    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(
        8,
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="6g",
        spark__checkpoint__dir=shared,
        spark__sql__ansi__enabled=os.environ.get("TEST_ANSI", "true"),
    )
    yield session
    session.stop()


@pytest.fixture()
def lines(spark):
    """Rows (n, value) from a list of lines."""

    def make(*values):
        return spark.createDataFrame(list(enumerate(values)), "n int, value string")

    return make
