import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from tunehouse.session import build_session

    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def fixture_dir():
    return os.path.join(ROOT, "fixtures")


@pytest.fixture
def one(spark):
    """Evaluate a Column built from literals."""
    return lambda column: spark.range(1).select(column.alias("v")).collect()[0]["v"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
