import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from shelfmark import build_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "shelfmark-tests", "local[8]", {"spark.sql.shuffle.partitions": "8"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="module", autouse=True)
def own_catalog(spark):
    """Tables and views of a module are gone for the next, which may use the same names."""
    yield
    for t in spark.catalog.listTables():
        if not t.isTemporary:
            spark.sql(f"DROP {'VIEW' if t.tableType == 'VIEW' else 'TABLE'} `{t.name}`")
