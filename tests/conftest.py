from __future__ import annotations

import pytest

from scenarios.compare import oracle_connection
from scenarios.feed import lake_of
from tidelog.session import session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    made = session(
        "local[8]", "tests", spark__sql__shuffle__partitions="3", spark__driver__memory="6g",
        spark__checkpoint__dir=shared, spark__sql__warehouse__dir=shared + "/warehouse",
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def lake(spark):
    return lake_of(spark, SF_DIR)


@pytest.fixture(scope="session")
def duck():
    return oracle_connection(SF_DIR)


@pytest.fixture
def rows_of():
    """Rows of a frame as a sorted list of tuples, columns in the given order."""

    def sort_key(row):
        return tuple((v is None, str(v)) for v in row)

    def read(frame, columns=None):
        return sorted((tuple(r) for r in frame.select(columns or frame.columns).collect()), key=sort_key)

    return read
