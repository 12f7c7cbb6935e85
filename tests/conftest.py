import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from farelane.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    from farelane.sources.roles import DerivedStar

    return DerivedStar(spark, SF)


@pytest.fixture(scope="module", autouse=True)
def nothing_left_cached():
    """A module's cached frames end with it, so that others may ask for a session without any."""
    yield
    active = SparkSession.getActiveSession()
    if active is not None:
        active.catalog.clearCache()
