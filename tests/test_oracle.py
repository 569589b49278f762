"""Every registered query against its SQL in another engine, on the smallest tables."""

import decimal
import math

import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    return round(v, 9) if isinstance(v, float) else v


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf, duck, name):
    got = entry.queries()[name](spark, sf)
    cursor = duck.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert table(got.columns, got.collect()) == table(columns, cursor.fetchall())


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
