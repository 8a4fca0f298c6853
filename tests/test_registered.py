"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as contract
from checks.oracle import statements
from checks.queries import registered
from compare import DATA, connect, difference

FOLDER = f"{DATA}/sf0.001"
QUERIES = registered()
SQL = statements()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 10


@pytest.mark.parametrize("partitions", ["1", "4", "200"])
def test_partition_counts_do_not_change_results(spark, con, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for name in ("silver_visualizacoes", "doc_unique_viewers", "q6_engagement_fanout"):
            assert difference(QUERIES[name](spark, FOLDER), con, SQL[name]) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
