"""Every registered query against its SQL."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as registered

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", registered.queries())
def test_query(spark, sf_dir, duck, name):
    df = registered.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = df.select(*columns).collect()
    sql = registered.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    relation = duck.execute(sql)
    names = [d[0] for d in relation.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = Counter(tuple(row[i] for i in order) for row in relation.fetchall())
    assert Counter(map(tuple, got)) == expected
    assert expected


def test_entry(spark):
    assert registered.entry(spark).count() > 0
