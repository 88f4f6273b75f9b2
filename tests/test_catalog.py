"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import pytest
from comparison import connect, differences

from spreadlab.catalog import all_checks, all_queries

QUERIES, CHECKS = all_queries(), all_checks()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, folder, con, name):
    df = QUERIES[name](spark, folder)
    if name in CHECKS:
        _, problems = differences(df, con, CHECKS[name])
        assert not problems, "\n".join(problems)
    else:
        df.count()


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


def test_entry_points(spark):
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).limit(1).count() == 1
