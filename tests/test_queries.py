"""Every registered query, and its SQL where it has one, on the small tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) or (math.isnan(a) and math.isnan(b))
    return a == b


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert entry_point.oracle_sql().keys() <= entry_point.queries().keys()


@pytest.mark.parametrize("name", list(entry_point.queries()))
def test_query(spark, duck, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = ordered(tuple(r) for r in df.select(*columns).collect())
    assert got
    sql = entry_point.oracle_sql().get(name)
    if sql is None:
        return
    relation = duck.sql(sql)
    assert sorted(relation.columns) == columns
    expected = ordered(relation.select(*[f'"{c}"' for c in columns]).fetchall())
    assert len(got) == len(expected)
    for mine, theirs in zip(got, expected):
        assert all(map(same, mine, theirs)), (mine, theirs)
