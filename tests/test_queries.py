"""Every registered query against its SQL, or against its own bound where SQL cannot say it."""

import pytest

import __spark_entry__ as entry_points
from muara.plans.queries import REGISTRY
from tests.compare import connect, differences

ORACLES = entry_points.oracle_sql()
QUERIES = entry_points.queries()


@pytest.fixture(scope="module")
def db(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(set(ORACLES) & set(REGISTRY)))
def test_query_equals_sql(spark, folder, db, name):
    assert differences(QUERIES[name](spark, folder), db, ORACLES[name]) == ""


def test_queries_without_sql_are_known():
    assert set(REGISTRY) - set(ORACLES) == {"table_sizes", "namespace_sizes"}
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert not entry_points.entry(spark).isEmpty()


def test_table_sizes_are_file_sizes(spark, folder):
    import os

    for row in QUERIES["table_sizes"](spark, folder).collect():
        assert row["bytes"] == os.path.getsize(f"{folder}/{row['table_name']}.parquet")
