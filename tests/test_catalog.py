"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from __spark_entry__ import oracle_sql as registered_sql
from __spark_entry__ import queries as registered
from check import connect, differences
from tickloom.catalog import all_oracles as oracle_sql
from tickloom.catalog import all_queries as queries

SF_DIR = "/root/testdata/sf0.001"
WITHOUT_SQL: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql_or_says_why():
    assert set(queries()) - set(oracle_sql()) == WITHOUT_SQL
    assert set(oracle_sql()) <= set(queries()) <= set(registered())
    assert set(registered_sql()) <= set(registered())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    assert differences(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) == []


def test_entry_has_rows_and_a_stable_schema(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.schema == entry(spark).schema


@pytest.mark.parametrize("name", ["feature_rows", "standardize_time", "csv_bars", "sql_functions", "cutoffs"])
def test_zone_and_partitions_of_the_session_do_not_matter(spark, con, name):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/New_York")
    other.conf.set("spark.sql.shuffle.partitions", "3")
    assert differences(queries()[name](other, SF_DIR), con, oracle_sql()[name]) == []
