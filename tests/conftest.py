import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shredloom.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    started = session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g"})
    started.sparkContext.setLogLevel("ERROR")
    yield started
    started.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows(df):
    """Rows as plain tuples, in an order that does not depend on the plan."""
    return sorted((tuple(row) for row in df.collect()), key=repr)
