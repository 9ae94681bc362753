"""The registered queries against their SQL on the smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from tools.check_oracle import TABLES, bag

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the given tables")
QUERIES, ORACLE = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_sql_has_its_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    ours, theirs = bag(df.columns, df.collect()), bag(columns, result.fetchall())
    assert ours == theirs, (Counter(ours - theirs).most_common(1),
                            Counter(theirs - ours).most_common(1))


def test_entry(spark):
    assert driver.entry(spark).count() > 0
