"""Every registered query against its SQL, at the smallest scale."""

import pytest
from check import compare, oracle

from __spark_entry__ import entry, oracle_sql, queries

SQLS = oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return oracle(small)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_matches_sql(spark, small, con, name):
    assert compare(queries()[name](spark, small), con, SQLS[name]) == ""


@pytest.mark.parametrize("name", sorted(set(queries()) - set(SQLS)))
def test_runs_without_sql(spark, small, name):
    assert queries()[name](spark, small).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", ["stream_of_changes", "stream_of_increments", "timecodes", "feed_at_many_times"])
def test_any_session_zone(spark, small, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert compare(queries()[name](spark, small), con, SQLS[name]) == ""
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
