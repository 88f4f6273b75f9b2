from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spreadlab.fixtures import Tables  # noqa: E402
from spreadlab.session import local_session  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # a shared folder as on a cluster, so the tests do not take the branch for a missing setting
    session = local_session("8", "tests", checkpoint_dir=str(tmp_path_factory.mktemp("shared")))
    session.conf.set("spark.sql.ui.explainMode", "simple")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, FOLDER)


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture
def plan():
    """Text of the physical plan."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
