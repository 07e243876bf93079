"""Every registered query against its SQL on the smallest data."""

import __spark_entry__ as spark_entry
import pytest
from oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES = spark_entry.REGISTRY.queries
SQL = spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(SQL)


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


def test_joined_lines_give_whole_sequences(spark, con):
    """The rows hold the sequences themselves, not only their lengths and checksums."""
    rows = QUERIES["udf2_lines_to_records"](spark, SF_DIR).select("sequence", "sequence_id")
    assert compare(rows, con, SQL["prj1_assemble_records"]) is None
