"""Every registered query against DuckDB on the given tables."""

import pytest
from compare import connect, mismatch

import workload

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    with connect(SF_DIR) as connection:
        yield connection


@pytest.mark.parametrize("name", list(workload.QUERIES))
def test_query_matches_sql(spark, con, name):
    got = workload.QUERIES[name](spark, SF_DIR).toPandas()
    if name in workload.SQL:
        assert mismatch(got, con.execute(workload.SQL[name]).df()) is None
    else:
        assert len(got)


def test_entry_and_names():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 100
