"""Every registered query against the checking SQL on the smallest tables."""

import pytest

import __spark_entry__ as spark_entry
from oracle import connect, differences
from placewell.registry.oracle import ORACLE
from placewell.registry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert differences(df, con, ORACLE[name]) == []


def test_reasons_when_the_first_split_has_no_row(spark, con):
    """Spark writes an empty first file then, one in each drop."""
    splits = {"spark.sql.files.maxPartitionBytes": "500", "spark.sql.files.openCostInBytes": "1"}
    for key, value in splits.items():
        spark.conf.set(key, value)
    try:
        df = QUERIES["ingest_first_error"](spark, SF_DIR)
        assert differences(df, con, ORACLE["ingest_first_error"]) == []
    finally:
        for key in splits:
            spark.conf.unset(key)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(spark_entry.queries())
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.columns[-1] == "rank_in_category"
    assert df.count() > 0
